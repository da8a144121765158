"""Removal of byte strings that stand in an earlier place, by suffix arrays of shards.

A window is a string of LENGTH bytes of a document's UTF-8 text. Each byte that lies in a
window which also starts earlier (in a document with a smaller id, or further up in its own)
is removed.

1. Equal windows must meet in one shard. Each window has an anchor: the 40 bytes in it whose
   digest is least, the leftmost of equal ones. Equal windows have equal anchors in the same
   place, so the windows of one anchor, which follow each other, form a piece, and only
   pieces with the same anchor have windows in common. A piece is a digest of its anchor, one
   of its bytes, and its place.
2. Pieces are dealt by anchor. Equal pieces become one, at the first place; all others of
   them are removed whole. Each task has joined its own equal pieces before. A sample of
   documents, bounded in bytes, shows anchors that stand in many different pieces, such as a
   short line that very many documents hold; their pieces are cut into single windows, each
   an anchor of its own, so no anchor's group is large. Where the sample misses one the
   result is the same.
3. Pieces that share an anchor with other ones are fetched and laid into shards. A shard's
   suffix array is built by induced sorting; the permuted common prefixes show the runs of
   suffixes that agree in LENGTH bytes; all places of a run but the first are removed.
4. What is removed is gathered per document and cut out.

Digests have 128 bits together and stand for the bytes in step 2.

Rows: documents are ordered by doc_id, NULL first; rows that share an id by the digest of
their text. Rows equal in id and text are one document and share their fate. NULL texts are
empty. Texts are whole, however long; a text is cut into overlapping blocks for step 1. No
rows give no rows. Columns of the input pass through; those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textstyle.llm.common import arrow_batches, fresh, settle
from textstyle.llm.induced import common_prefixes, suffix_array

LENGTH, GRAM = 100, 40
# Bytes of text that are looked at together, of a shard, and of the sample for wide anchors.
BLOCK, SHARD, SAMPLE = 1 << 20, 1 << 20, 16 << 20
# Different pieces in the sample that make an anchor a wide one.
WIDE = 32
# Pieces that a bucket sorts, about.
BUCKET = 500_000
NO_ID = -(2**63)
RESULTS = ("kept", "removed")
# Symbols of shards: 0 at the end, 1 between pieces, bytes from 2 on.
SYMBOLS = 258

_BASE = 0x9E3779B97F4A7C15
_WORD = 1 << 64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@cache
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, and a random word for each byte."""
    size = 2 * BLOCK + LENGTH + 1
    up, down = (np.full(size, x, dtype=np.uint64) for x in (_BASE, pow(_BASE, -1, _WORD)))
    up[0] = down[0] = 1
    words = np.random.default_rng(11).integers(0, _WORD - 1, 256, dtype=np.uint64)
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64), words


class Pieces:
    """The pieces of a block of texts: anchor digest h, digest d, start and end in the block."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                 wide: np.ndarray | None = None):
        up, down, words = _powers()
        n = len(data)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(words[data] * up[:n], dtype=np.uint64, out=self.sums[1:])
        grams = mix((self.sums[GRAM:] - self.sums[:-GRAM]) * down[: n - GRAM + 1])
        # High bits of the digest, then the place: the least is the leftmost of equal ones.
        low = np.uint64((1 << 23) - 1)
        least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        width, have = LENGTH - GRAM + 1, 1
        while have * 2 <= width:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        rest = width - have
        least = np.minimum(least[: len(least) - rest], least[rest:])
        anchor = (least & low).astype(np.int64)
        inside = np.zeros(n + 1, dtype=np.int8)
        fits = ends - starts >= LENGTH
        np.add.at(inside, starts[fits], 1)
        np.add.at(inside, ends[fits] - LENGTH + 1, -1)
        windows = np.flatnonzero(np.cumsum(inside[: len(anchor)], dtype=np.int8))
        at = anchor[windows]
        new = np.ones(len(windows), dtype=bool)
        new[1:] = (at[1:] != at[:-1]) | (windows[1:] != windows[:-1] + 1)
        if wide is not None and len(wide):
            of = grams[at]
            found = np.minimum(np.searchsorted(wide, of), len(wide) - 1)
            single = wide[found] == of
            new |= single
            new[1:] |= single[:-1]
        first = np.flatnonzero(new)
        self.start = windows[first]
        self.end = windows[np.r_[first[1:], len(windows)] - 1] + LENGTH if len(first) else self.start
        self.d = mix((self.sums[self.end] - self.sums[self.start]) * down[self.start] + np.uint64(7))
        self.h = grams[at[first]]
        if wide is not None and len(wide):
            # A window of a wide anchor is an anchor of its own.
            alone = single[first]
            self.h[alone] = mix(self.d[alone] ^ np.uint64(0xA5A5A5A5A5A5A5A5))


def blocks(batch: pd.DataFrame) -> Iterator[tuple[np.ndarray, ...]]:
    """(bytes, row numbers, starts, ends, offsets) of about BLOCK bytes. A text that is
    longer is cut into blocks that overlap by a window less one byte."""
    held: list[bytes] = []
    rows: list[int] = []
    offsets: list[int] = []
    size = 0

    def laid() -> tuple[np.ndarray, ...]:
        ends = np.cumsum([len(x) for x in held])
        return (np.frombuffer(b"".join(held), np.uint8), np.array(rows), np.r_[0, ends[:-1]], ends,
                np.array(offsets))

    for row, text in enumerate(batch["text"]):
        data = text.encode()
        for at in range(0, max(len(data) - LENGTH + 1, 1), BLOCK):
            held.append(data[at : at + BLOCK + LENGTH - 1])
            rows.append(row)
            offsets.append(at)
            size += len(held[-1])
            if size >= BLOCK:
                yield laid()
                held, rows, offsets, size = [], [], [], 0
    if held:
        yield laid()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64("text").alias("tag"), "text",
    ).filter(F.octet_length("text") >= LENGTH)


def wide_anchors(docs: DataFrame, share: float) -> np.ndarray:
    """Digests of anchors that stand in WIDE different pieces of a share of the documents.

    A sample has at most about SAMPLE / 30 pieces, so there are few thousands of them.
    """

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data, _, starts, ends, _ in blocks(batch):
                pieces = Pieces(data, starts, ends)
                yield pd.DataFrame({"h": pieces.h.view(np.int64), "d": pieces.d.view(np.int64)})

    sample = _texts(docs if share >= 1 else docs.sample(share, seed=5))
    found = sample.mapInPandas(emit, "h long, d long").distinct().groupBy("h").agg(
        F.count("*").alias("n")).filter(F.col("n") >= WIDE).select("h")
    return np.sort(np.array([row["h"] for row in found.collect()], dtype=np.int64).view(np.uint64))


BLOB = ("bucket int, doc binary, tag binary, row binary, h binary, d binary, start binary, "
        "size binary")
FOUND = "doc long, tag long, start long, size int, h long"
KINDS = {"doc": "<i8", "tag": "<i8", "row": "<u4", "h": "<u8", "d": "<u8", "start": "<u4",
         "size": "<u4"}


def _columns(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def repeated_pieces(docs: DataFrame, buckets: int, wide: np.ndarray) -> DataFrame:
    """(doc, tag, start, size, h): pieces that equal an earlier one, with h NULL, and the
    first ones of all pieces that share an anchor with different pieces."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            docs, tags = batch["doc"].to_numpy(), batch["tag"].to_numpy()
            rank = np.empty(len(batch), dtype=np.int64)
            rank[np.lexsort((tags, docs))] = np.arange(len(batch))
            for data, rows, starts, ends, offsets in blocks(batch):
                pieces = Pieces(data, starts, ends, wide)
                text = np.searchsorted(starts, pieces.start, "right") - 1
                start = pieces.start - starts[text] + offsets[text]
                row, size = rows[text], pieces.end - pieces.start
                order = np.lexsort((start, rank[row], pieces.d, pieces.h))
                h, d = pieces.h[order], pieces.d[order]
                row, start, size = row[order], start[order], size[order]
                first = np.ones(len(h), dtype=bool)
                first[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
                begin = np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))
                # Rows equal in id and text are one document, not repeats of each other.
                again = ~first & (docs[row] == docs[row[begin]]) & (
                    tags[row] == tags[row[begin]]) & (start == start[begin])
                h, d, row, start, size, first = (
                    x[~again] for x in (h, d, row, start, size, first))
                bucket = np.where(first, (mix(h) % np.uint64(buckets)).astype(np.int64), -1)
                inner = np.argsort(bucket, kind="stable")
                edges = np.flatnonzero(np.r_[True, np.diff(bucket[inner]) != 0, True]) \
                    if len(inner) else [0]
                out = []
                for low, high in zip(edges[:-1], edges[1:], strict=True):
                    part = inner[low:high]
                    met, place = np.unique(row[part], return_inverse=True)
                    values = {"doc": docs[met], "tag": tags[met], "row": place, "h": h[part],
                              "d": d[part], "start": start[part], "size": size[part]}
                    to = int(bucket[part[0]])
                    # Repeats inside the task need not meet others: any bucket takes them.
                    out.append((to, *(values[c].astype(KINDS[c]).tobytes() for c in KINDS)))
                yield pd.DataFrame(out, columns=_columns(BLOB))

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        rows = {c: [np.frombuffer(x, kind) for x in group[c]] for c, kind in KINDS.items()}
        for c in ("doc", "tag"):
            rows[c] = [values[at] for values, at in zip(rows[c], rows["row"], strict=True)]
        doc, tag, h, d, start, size = (
            np.concatenate(rows[c]) for c in ("doc", "tag", "h", "d", "start", "size"))
        if group["bucket"].iloc[0] < 0:
            return _frame(doc, tag, start, size, None)
        order = np.lexsort((start, tag, doc, d, h))
        doc, tag, h, d, start, size = (x[order] for x in (doc, tag, h, d, start, size))
        opens = np.r_[True, h[1:] != h[:-1]]
        new = opens | np.r_[True, d[1:] != d[:-1]]
        begin = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
        later = (doc != doc[begin]) | (tag != tag[begin]) | (start != start[begin])
        different = np.add.reduceat(new.astype(np.int64), np.flatnonzero(opens))
        shared = new & (different[np.cumsum(opens) - 1] > 1)
        return pd.concat([
            _frame(*(x[later] for x in (doc, tag, start, size)), None),
            _frame(*(x[shared] for x in (doc, tag, start, size, h))),
        ])

    blobs = _texts(docs).mapInPandas(emit, BLOB).withColumn(
        # Rows of one bucket at most hold what a block keeps; those settled go anywhere.
        "to", F.when(F.col("bucket") < 0, -1 - F.pmod(F.xxhash64("h"), F.lit(buckets)))
        .otherwise(F.col("bucket")),
    )
    with arrow_batches(docs.sparkSession, 1000):
        return settle(blobs.groupBy("to").applyInPandas(meet, FOUND), "suffix-pieces")


def _frame(doc, tag, start, size, h) -> pd.DataFrame:
    missing = h is None
    h = np.zeros(len(doc), np.int64) if missing else h.view(np.int64)
    return pd.DataFrame({
        "doc": doc, "tag": tag, "start": start.astype(np.int64), "size": size.astype(np.int32),
        "h": pd.arrays.IntegerArray(h, np.full(len(doc), missing)),
    })


MARK = "doc long, tag long, start long, size int"


def repeated_windows(group: pd.DataFrame) -> pd.DataFrame:
    """Where the pieces of a shard hold windows that start earlier in the shard."""
    places = group[["doc", "tag"]].apply(tuple, axis=1)
    ranks = {place: i for i, place in enumerate(sorted(set(places)))}
    rank = np.array([ranks[place] for place in places], dtype=np.int64)
    begin = group["start"].to_numpy()
    sizes = np.array([len(x) for x in group["content"]], dtype=np.int64)
    text = np.frombuffer(b"\0".join(group["content"]) + b"\0", np.uint8).astype(np.int16) + 2
    ends = np.cumsum(sizes + 1) - 1
    text[ends] = 1
    text = np.r_[text, 0].astype(np.int16)
    order = suffix_array(text, SYMBOLS)
    shared = common_prefixes(text, order, 1)[order]
    run = np.cumsum(shared < LENGTH)
    piece = np.repeat(np.arange(len(group)), sizes + 1)
    offset = np.arange(len(piece)) - (ends - sizes)[piece]
    at = order[order < len(piece)]
    run = run[order < len(piece)]
    key = (rank[piece] << 40) + begin[piece] + offset
    least = np.minimum.reduceat(key[at], np.flatnonzero(np.r_[True, run[1:] != run[:-1]]))
    number = np.cumsum(np.r_[True, run[1:] != run[:-1]]) - 1
    later = np.zeros(len(piece) + 1, dtype=bool)
    later[at] = key[at] > least[number]
    # Suffixes shorter than a window share none.
    later[:-1] &= offset + LENGTH <= sizes[piece]
    low = np.flatnonzero(later[:-1] & np.r_[True, ~later[:-2]])
    high = np.flatnonzero(later[:-1] & ~later[1:])
    return pd.DataFrame({
        "doc": group["doc"].to_numpy()[piece[low]], "tag": group["tag"].to_numpy()[piece[low]],
        "start": begin[piece[low]] + offset[low],
        "size": (high - low + LENGTH).astype(np.int32),
    })


def _spans() -> Column:
    """Start and size in one number, which goes to Python as it is."""
    return F.shiftleft("start", 32).bitwiseOR(F.col("size").cast("long"))


def _edges(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start = spans >> 32
    return start, start + (spans & 0xFFFFFFFF)


def _contents(pieces: DataFrame, docs: DataFrame) -> DataFrame:
    """The pieces with their bytes."""
    wanted = pieces.select("doc", "tag", "h", _spans().alias("span")).groupBy("doc", "tag").agg(
        F.sort_array(F.collect_list(F.struct("span", "h"))).alias("pieces")
    ).select("doc", "tag", F.col("pieces.span").alias("spans"), F.col("pieces.h").alias("hs"))

    def slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            contents: list[bytes] = []
            starts = []
            for text, spans in zip(batch["text"], batch["spans"], strict=True):
                data = text.encode()
                start, stop = _edges(spans)
                starts.append(start)
                contents += [data[a:b] for a, b in zip(start.tolist(), stop.tolist(), strict=True)]
            counts = [len(s) for s in starts]
            yield pd.DataFrame({
                "doc": np.repeat(batch["doc"].to_numpy(), counts),
                "tag": np.repeat(batch["tag"].to_numpy(), counts),
                "h": np.concatenate([np.empty(0, np.int64), *batch["hs"]]),
                "start": np.concatenate([np.empty(0, np.int64), *starts]), "content": contents,
            })

    # Rows equal in id and text are one document.
    texts = _texts(docs).join(wanted, ["doc", "tag"])
    return texts.mapInPandas(slices, "doc long, tag long, h long, start long, content binary")


def marks(docs: DataFrame, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """(doc, tag, start, size) of bytes to remove; parts may overlap."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    wide = wide_anchors(docs, min(1.0, sample / max(total, 1)))
    buckets = max(total // (BUCKET * 30), docs.sparkSession.sparkContext.defaultParallelism)
    found = repeated_pieces(docs, buckets, wide)
    shared = found.filter("h IS NOT NULL")
    volume = shared.agg(F.coalesce(F.sum("size").cast("long"), F.lit(0))).first()[0]
    with arrow_batches(docs.sparkSession, 200):
        contents = settle(_contents(shared, docs).dropDuplicates(["doc", "tag", "h", "start"]),
                          "suffix-contents")
    shards = volume // shard + 1
    dealt = contents.withColumn("shard", F.pmod(F.hash("h"), F.lit(shards)))
    # Sorting suffixes costs more than the bytes tell: few shards are not put into one task.
    spread = min(shards, 16 * docs.sparkSession.sparkContext.defaultParallelism)
    repeated = dealt.repartition(spread, "shard").groupBy("shard").applyInPandas(
        repeated_windows, MARK)
    return found.filter("h IS NULL").select("doc", "tag", "start", "size").union(repeated)


CUT = "kept binary, removed array<struct<start:long,stop:long>>"


def cut_out(text: pd.Series, parts: pd.Series) -> pd.DataFrame:
    """The bytes outside the parts, and the parts, joined where they meet."""
    kept, removed = [], []
    for value, spans in zip(text, parts, strict=True):
        data = value.encode() if value else b""
        if spans is None or not len(spans):
            kept.append(data)
            removed.append([])
            continue
        start, stop = _edges(np.sort(spans))
        stop = np.maximum.accumulate(stop)
        first = np.flatnonzero(np.r_[True, start[1:] > stop[:-1]])
        low, high = start[first], np.r_[stop[first[1:] - 1], stop[-1]]
        edges = zip(np.r_[0, high], np.r_[low, len(data)], strict=True)
        kept.append(b"".join(data[a:b] for a, b in edges))
        removed.append([{"start": a, "stop": b} for a, b in
                        zip(low.tolist(), high.tolist(), strict=True)])
    return pd.DataFrame({"kept": kept, "removed": removed})


def without_repeats(docs: DataFrame, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """Documents with ``kept``, the bytes that are left, and ``removed``, the spans that are
    not, in bytes of the text."""
    own = docs.drop(*RESULTS)
    doc, tag, parts, cut = fresh(own, "doc", "tag", "parts", "cut")
    repeats = marks(own.select("doc_id", "text"), shard, sample)
    gathered = settle(repeats, "suffix-marks").groupBy(
        F.col("doc").alias(doc), F.col("tag").alias(tag)
    ).agg(F.collect_list(_spans()).alias(parts))
    joined = own.withColumn(doc, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn(
        tag, F.xxhash64("text")).join(gathered, [doc, tag], "left")
    return joined.withColumn(cut, F.pandas_udf(cut_out, CUT)("text", parts)).select(*own.columns, f"{cut}.*")
