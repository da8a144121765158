"""Collocated phrases by FM-indexes over word numbers.

Texts are cut into pieces and words, and every task lays the words of a language, piece after
piece, into shards of bounded size. A shard is an FM-index: its own vocabulary and the
Burrows-Wheeler transform of its word numbers, from which the steps to the left (LF) and to
the right (its inverse) follow. The interval of a phrase is extended in both directions: a
(k+1)-gram is the part of its first k words' interval whose suffixes, one step to the right,
lie in the interval of its last k words; so it is a right extension of the one and a left
extension of the other, and all intervals of a depth are extended at once.

Counts are summed across shards: every shard sends the digests and counts of its phrases in
blobs, one per bucket of digests; a bucket adds them up and tells each shard which of its
phrases reach the least count. A phrase is extended only if both its ends reach it, first for
words, then for pairs, then for all longer phrases. The longest phrases of the language thus
never leave their shards unless all their pairs are frequent. The first shard that holds a
phrase speaks for it: it has the words, and the counts of all the phrase's parts.

Phrases are told apart by 64 bits and the bucket, which comes from other bits.

Rows: NULL and empty texts have no words; a NULL language is ``und``. Repeated rows count
each. Very long texts are laid over several shards, cut between pieces; a single piece stays
whole. Equal scores are ordered by count, then by the phrase's bytes. No rows give no rows.
Only ``lang`` and ``text`` are read, other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textstyle.llm.common import arrow_batches, settle

LONGEST, LEAST, TOP = 5, 100, 2000
# Bytes of text that make a shard, and that all open shards of a task may hold.
SHARD, OPEN = 8 << 20, 32 << 20
# Digests that a bucket adds up, about.
BUCKET = 2_000_000
NO_LANGUAGE = "und"

# What ends a piece; words lie between spaces and tabs.
PIECE_END = b".,;:!?\n\x0b\x0c\r"
# No UTF-8 text holds this byte.
BREAK = b"\xff"
_LOWER = bytes.maketrans(
    bytes(range(65, 91)) + PIECE_END + b"\t",
    bytes(range(97, 123)) + BREAK * len(PIECE_END) + b" ",
)

INDEX = "lang string, shard long, n long, vocabulary binary, width int, bwt binary"
BLOB = "lang string, bucket int, shard long, keys binary, counts binary"
REPLY = "lang string, shard long, keys binary, totals binary, speaks binary"
FOUND = ("lang string, size int, key long, first long, last long, phrase string, a long, "
         "ls array<long>, rs array<long>")


def mix(x: np.ndarray) -> np.ndarray:
    """Digests of 64-bit numbers."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes of word numbers in order. Every 0 ends a piece and is told from all others, so
    no comparison passes it; the text ends with one. Those still equal after 1, 2, 4, ...
    words are sorted by their next ones."""
    size = len(text)
    ends = text == 0
    start = np.where(ends, np.cumsum(ends) - 1, text.astype(np.int64) + size)
    active, step = np.arange(size), 0
    rank = np.zeros(size, dtype=np.int64)
    key = start
    while len(active):
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        group = rank[active]
        place = np.arange(len(active))
        opens = np.r_[True, group[1:] != group[:-1]]
        new = np.r_[True, key[1:] != key[:-1]]
        first = np.maximum.accumulate(np.where(opens, place, 0))
        begin = np.maximum.accumulate(np.where(new, place, 0))
        rank[active] = group + begin - first
        alone = new & np.r_[new[1:], True]
        active = active[~alone]
        step = 2 * step or 1
        key = rank[active] * (size + 1) + rank[np.minimum(active + step, size - 1)]
    order = np.empty(size, dtype=np.int64)
    order[rank] = np.arange(size)
    return order


def index_row(data: bytes) -> tuple[int, bytes, int, bytes]:
    """(words, vocabulary, bytes per number, BWT) of lowered texts with their breaks."""
    tokens = pa.array((data + BREAK).replace(BREAK, b" " + BREAK + b" ").split(), pa.binary())
    coded = tokens.dictionary_encode()
    words = coded.dictionary.to_pylist()
    ending = words.index(BREAK)
    number = np.arange(1, len(words) + 1)
    number[ending + 1 :] -= 1
    number[ending] = 0
    text = number[coded.indices.to_numpy()]
    # Breaks without words between them are one; none stands at the start.
    text = text[(text != 0) | np.r_[False, text[:-1] != 0]]
    del words[ending]
    kind = np.dtype("<u2") if len(words) < 1 << 16 else np.dtype("<u4")
    bwt = text[suffix_order(text) - 1] if len(text) else text
    return int((text != 0).sum()), BREAK.join(words), kind.itemsize, bwt.astype(kind).tobytes()


def _blocks(data: bytes, limit: int) -> Iterator[bytes]:
    """``data`` in parts of about ``limit`` bytes, cut at breaks."""
    start = 0
    while len(data) - start > limit:
        cut = data.find(BREAK, start + limit)
        if cut < 0:
            break
        yield data[start:cut]
        start = cut + 1
    yield data[start:]


def build(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """A row per shard: its language, number of words, vocabulary and BWT."""

    def lay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number = TaskContext.get().partitionId() << 32, 0
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def close(lang: str) -> pd.DataFrame | None:
            nonlocal number
            row = index_row(BREAK.join(held.pop(lang)))
            del sizes[lang]
            number += 1
            if not row[0]:
                return pd.DataFrame(columns=columns)
            return pd.DataFrame([(lang, part + number, *row)], columns=columns)

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                for block in _blocks(text.encode().translate(_LOWER), shard):
                    held.setdefault(lang, []).append(block)
                    sizes[lang] = sizes.get(lang, 0) + len(block) + 1
                    if sizes[lang] >= shard:
                        yield close(lang)
                    elif sum(sizes.values()) >= OPEN:
                        yield close(max(sizes, key=sizes.get))
        for lang in list(held):
            yield close(lang)

    columns = [part.split()[0] for part in INDEX.split(", ")]
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), "text"
    ).filter("text <> ''")
    with arrow_batches(docs.sparkSession, 1000):
        return settle(rows.mapInPandas(lay, INDEX), "phrase-index")


class Shard:
    """The intervals of a shard's phrases, depth by depth.

    ``own[p]`` is the number of the interval that suffix p lies in, -1 outside all.
    """

    def __init__(self, vocabulary: bytes, width: int, bwt: bytes):
        self.words = vocabulary.split(BREAK)
        hashes = [xxhash.xxh3_64_intdigest(word) for word in self.words]
        self.hashes = np.array([0, *hashes], dtype=np.uint64)
        text = np.frombuffer(bwt, f"<u{width}")
        # One step to the right: the inverse of LF.
        self.right = np.argsort(text, kind="stable")
        self.first = text[self.right]
        self.own = np.where(self.first == 0, -1, self.first.astype(np.int64) - 1)
        # At depth 1 the interval of a word has the word's number.
        self.counts = np.bincount(text, minlength=len(self.words) + 1)[1:]
        self.keys = mix(self.hashes[1:])
        self.starts = np.cumsum(np.r_[(text == 0).sum(), self.counts])[:-1]

    def keep(self, alive: np.ndarray) -> None:
        """Leave the intervals that are not ``alive``."""
        # The last number stands for those outside all intervals.
        number = np.r_[np.where(alive, np.cumsum(alive) - 1, -1), -1]
        self.own = number[self.own]
        self.keys, self.counts = self.keys[alive], self.counts[alive]
        self.starts = self.starts[alive]

    def extend(self) -> None:
        """From the phrases of k words to those of k + 1 whose both ends are there."""
        head, tail = self.own, self.own[self.right]
        inside = (head >= 0) & (tail >= 0)
        new = np.ones(len(head), dtype=bool)
        new[1:] = (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])
        starts = np.flatnonzero(inside & new)
        number = np.cumsum(inside & new) - 1
        self.heads, self.tails = head[starts], tail[starts]
        self.own = np.where(inside, number, -1)
        self.counts = np.bincount(self.own[inside], minlength=len(starts))
        turned = self.keys[self.tails]
        turned = (turned << np.uint64(21)) | (turned >> np.uint64(43))
        self.keys = mix(self.hashes[self.first[starts]] ^ turned)
        self.starts = starts


def _blobs(lang: str, shard: int, keys: np.ndarray, counts: np.ndarray, buckets: int) -> list:
    bucket = (mix(keys ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    bucket, keys, counts = bucket[order], keys[order], counts[order]
    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(keys) else [0]
    return [
        (lang, int(bucket[a]), shard, keys[a:b].astype("<u8").tobytes(),
         counts[a:b].astype("<u4").tobytes())
        for a, b in zip(edges[:-1], edges[1:], strict=True)
    ]


def _sums(blobs: DataFrame, least: int, name: str) -> DataFrame:
    """Per shard, which of its phrases are met ``least`` times in all shards of the language,
    how often, and whether the shard speaks for them."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        sizes = [len(keys) // 8 for keys in group["keys"]]
        keys = np.frombuffer(b"".join(group["keys"]), "<u8")
        counts = np.frombuffer(b"".join(group["counts"]), "<u4").astype(np.int64)
        order = np.argsort(keys, kind="stable")
        new = np.r_[True, keys[order][1:] != keys[order][:-1]]
        totals = np.empty(len(keys), dtype=np.int64)
        totals[order] = np.add.reduceat(counts[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        speaks = np.zeros(len(keys), dtype=np.uint8)
        speaks[order[new]] = 1
        rows, at = [], 0
        for lang, shard, size in zip(group["lang"], group["shard"], sizes, strict=True):
            part = slice(at, at + size)
            at += size
            kept = totals[part] >= least
            if kept.any():
                rows.append((lang, shard, keys[part][kept].tobytes(),
                             totals[part][kept].astype("<i8").tobytes(),
                             speaks[part][kept].tobytes()))
        return pd.DataFrame(rows, columns=columns)

    columns = [part.split()[0] for part in REPLY.split(", ")]
    return settle(blobs.groupBy("lang", "bucket").applyInPandas(add, REPLY), name)


class Totals:
    """The replies to a shard: totals by digest."""

    def __init__(self, replies: pd.DataFrame):
        keys = np.frombuffer(b"".join(replies["keys"]), "<u8")
        order = np.argsort(keys)
        self.keys = keys[order]
        self.totals = np.frombuffer(b"".join(replies["totals"]), "<i8")[order]
        self.speaks = np.frombuffer(b"".join(replies["speaks"]), np.uint8)[order]

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(total or 0, whether the shard speaks) for each digest."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        met = self.keys[at] == keys
        return np.where(met, self.totals[at], 0), met & (self.speaks[at] == 1)


def _first_counts(index: DataFrame, buckets: int) -> DataFrame:
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list = []
            for row in batch.itertuples():
                shard = Shard(row.vocabulary, row.width, row.bwt)
                rows += _blobs(row.lang, row.shard, shard.keys, shard.counts, buckets)
            yield pd.DataFrame(rows, columns=[p.split()[0] for p in BLOB.split(", ")])

    return index.mapInPandas(emit, BLOB)


def _pass(index: DataFrame, replies: DataFrame, work, schema: str) -> DataFrame:
    """``work(lang, number, shard, totals)`` gives rows for each shard with replies."""
    columns = [part.split()[0] for part in re.sub(r"<\w+>", "", schema).split(", ")]

    def run(rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        found: list = []
        if len(told):
            for row in rows.itertuples():
                shard = Shard(row.vocabulary, row.width, row.bwt)
                found += work(row.lang, row.shard, shard, Totals(told))
        return pd.DataFrame(found, columns=columns)

    keys = ("lang", "shard")
    return index.groupBy(*keys).cogroup(replies.groupBy(*keys)).applyInPandas(run, schema)


def phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP,
            shard: int = SHARD) -> DataFrame:
    """The ``top`` phrases of each language by the score of their weakest cut: lang, rank,
    phrase, a, l, r, n, score.

    Phrases have 2 to ``longest`` words and are met ``least`` times; those that a longer such
    phrase always contains are left out. Cut into parts met l and r times, a phrase met a
    times among n words scores floor(1000 a n / (l r)).
    """
    index = build(docs, shard)
    total = index.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(total // BUCKET, 1)

    def pairs(lang: str, number: int, index: Shard, totals: Totals) -> list:
        index.keep(totals.of(index.keys)[0] > 0)
        index.extend()
        return _blobs(lang, number, index.keys, index.counts, buckets)

    def longer(lang: str, number: int, index: Shard, totals: Totals) -> list:
        index.keep(totals.of(index.keys)[0] > 0)
        index.extend()
        index.keep(totals.of(index.keys)[0] > 0)
        rows: list = []
        for _ in range(3, longest + 1):
            index.extend()
            rows += _blobs(lang, number, index.keys, index.counts, buckets)
        return rows

    def speak(lang: str, number: int, index: Shard, totals: Totals) -> list:
        depths, rows = [], []
        for size in range(1, longest + 1):
            if size > 1:
                index.extend()
            met, speaks = totals.of(index.keys)
            index.keep(met > 0)
            met, speaks = totals.of(index.keys)
            own = index.own
            depths.append((own, index.keys, met))
            if size < 2 or not len(met):
                continue
            for at in np.flatnonzero(speaks).tolist():
                places = [int(index.starts[at])]
                for _ in range(size - 1):
                    places.append(int(index.right[places[-1]]))
                begin, after = places[0], places[1]
                words = [index.words[index.first[p] - 1] for p in places]
                below, keys, _ = depths[-2]
                rows.append((
                    lang, size, int(index.keys[at].astype(np.int64)),
                    int(keys[below[begin]].astype(np.int64)),
                    int(keys[below[after]].astype(np.int64)),
                    b" ".join(words).decode(), int(met[at]),
                    [int(depths[k - 1][2][depths[k - 1][0][begin]]) for k in range(1, size)],
                    [int(depths[size - k - 1][2][depths[size - k - 1][0][places[k]]])
                     for k in range(1, size)],
                ))
        return rows

    words = _sums(_first_counts(index, buckets), least, "phrase-words")
    pair_totals = _sums(_pass(index, words, pairs, BLOB), least, "phrase-pairs")
    told = words.union(pair_totals)
    if longest > 2:
        long_totals = _sums(_pass(index, told, longer, BLOB), least, "phrase-longer")
        told = told.union(long_totals)
    found = settle(_pass(index, told, speak, FOUND), "phrases")
    return _ranked(found, index, top)


def _ranked(found: DataFrame, index: DataFrame, top: int) -> DataFrame:
    """The phrases that no extension always contains, scored and ranked."""
    extended = found.filter("size > 2").select(
        "lang", (F.col("size") - 1).alias("size"), "a",
        F.explode(F.array("first", "last")).alias("key"),
    ).distinct()
    left = found.join(extended, ["lang", "size", "key", "a"], "left_anti")
    # One row per language.
    words = index.groupBy("lang").agg(F.sum("n").alias("n"))
    cuts = F.expr("""
        array_min(transform(ls, (l, i) -> struct(
            (CAST(1000 AS DECIMAL(38, 0)) * a * n) div (CAST(l AS DECIMAL(38, 0)) * rs[i])
                AS score, i, l, rs[i] AS r)))
    """)
    scored = left.join(words, "lang").select(
        "lang", "phrase", "a", "n", "key", cuts.alias("cut")
    ).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", "key")
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    # First within parts of a language, so that no task orders all its phrases.
    part = F.pmod("key", F.lit(64))
    inside = scored.withColumn("part", part).withColumn(
        "place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    ).filter(F.col("place") <= top)
    ranked = inside.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l",
                         "r", "n", "score")
