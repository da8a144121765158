"""Packing token sequences along a space-filling curve.

Each text is tokenised once; its token counts, hashed to a vector of fixed length, are
projected to a few dimensions, and the cell's place on a Hilbert curve is the document's
key. Documents are range-sorted by key, so that neighbours on the curve follow each other,
laid end to end, and cut into sequences.

Only keys and lengths are sorted. Every partition adds up its own lengths, the sums of the
partitions give each document its place in the whole, and then each document is cut by
itself: no task holds more than its share, and equal keys may fill many partitions.

Rows: NULL and empty texts are their end mark alone. Repeated rows are packed each. The
order is key, doc_id (NULL first), then the row. Very long texts are cut over as many
sequences as they fill. No rows give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textstyle.llm.common import arrow_batches, settle

END_ID = 0
LENGTH = 1024
# Hashed vectors have BUCKETS entries, curves DIMENSIONS axes of 2 ** BITS cells.
BUCKETS, DIMENSIONS, BITS = 256, 4, 10
# Chunks of text whose ids a worker keeps.
CACHED = 300_000

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

# White space followed by a space that a word does not take: a match may cross it.
CROSSING = re.compile(r"\s \s|\s \Z")
# A chunk that may stand before and after others of its kind.
PLAIN = re.compile(r" \S+")


class Encoder:
    """Token ids of texts as little-endian unsigned 16-bit numbers.

    A text is split before each space; no token crosses such a place unless white space
    stands around it, so each chunk has the same ids in every text and is encoded once.
    The new chunks of many texts are encoded together: laid end to end, they are cut apart
    again by the lengths of their tokens. ``ranks`` are the same vocabulary for the faster
    library. Texts with special strings or with runs of white space around spaces go through
    the tokenizer as a whole.
    """

    def __init__(self, tokenizer: str = TOKENIZER, ranks: str = RANKS):
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(tokenizer)
        added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        with open(ranks, "rb") as lines:
            merges = {
                base64.b64decode(token): int(rank)
                for token, rank in (line.split() for line in lines)
            }
        self.parts = tiktoken.Encoding(
            "parts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}
        )
        self.lengths = np.zeros(max(merges.values()) + 1, dtype=np.int64)
        for token, rank in merges.items():
            self.lengths[rank] = len(token)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [None if self.special.search(text) or CROSSING.search(text) else
                 [text] if "\0" in text else text.replace(" ", "\0 ").split("\0")
                 for text in texts]
        needed = set().union(*[chunks for chunks in split if chunks])
        self.learn(list(needed - self.known.keys()))
        if len(self.known) > CACHED:
            # What these texts hold is kept, and with it all that is frequent.
            self.known = {chunk: self.known[chunk] for chunk in needed}
        find = self.known.__getitem__
        return [
            self.pack(self.whole.encode(text, add_special_tokens=False).ids)
            if chunks is None else b"".join(map(find, chunks))
            for text, chunks in zip(texts, split, strict=True)
        ]

    def learn(self, chunks: list[str]) -> None:
        """Encode chunks that are not known."""
        plain = [chunk for chunk in chunks if PLAIN.fullmatch(chunk)]
        ids = np.asarray(self.parts.encode_ordinary("".join(plain)), dtype=np.int64)
        ends = np.cumsum([len(chunk.encode()) for chunk in plain])
        cuts = np.searchsorted(np.cumsum(self.lengths[ids]), ends, "left") + 1 if plain else []
        data, low = self.pack(ids), 0
        for chunk, high in zip(plain, (2 * np.asarray(cuts, np.int64)).tolist(), strict=True):
            self.known[chunk] = data[low:high]
            low = high
        for chunk in set(chunks).difference(plain):
            self.known[chunk] = self.pack(self.parts.encode_ordinary(chunk))

    @staticmethod
    def pack(ids) -> bytes:
        return np.asarray(ids, dtype="<u2").tobytes()


@cache
def _encoder(tokenizer: str, ranks: str) -> Encoder:
    return Encoder(tokenizer, ranks)


@cache
def _projection() -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each id, and the directions on which hashed vectors are projected."""
    ids = np.arange(1 << 16, dtype=np.uint64)
    bucket = (ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)
    random = np.random.default_rng(7)
    directions, _ = np.linalg.qr(random.standard_normal((BUCKETS, DIMENSIONS)))
    return bucket.astype(np.int64) % BUCKETS, directions


def document_vector(ids: np.ndarray) -> np.ndarray:
    bucket, _ = _projection()
    vector = np.sqrt(np.bincount(bucket[ids], minlength=BUCKETS))
    return vector / max(np.linalg.norm(vector), 1e-12)


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers, axes by columns.

    From the highest bit down, each axis' bit decides how the lower bits of the first axis
    are mirrored or swapped; the Gray code of the result, read across the axes, is the key.
    """
    x = cells.astype(np.int64).T.copy()
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for axis in range(len(x)):
            mirrored = (x[axis] >> level & 1).astype(bool)
            swapped = (x[0] ^ x[axis]) & low
            x[0] ^= np.where(mirrored, low, swapped)
            x[axis] ^= np.where(mirrored, 0, swapped)
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(len(x)):
            key = key << 1 | (x[axis] >> level & 1)
    return key


def curve_keys(vectors: np.ndarray) -> np.ndarray:
    _, directions = _projection()
    cells = np.floor((vectors @ directions + 1) / 2 * (1 << BITS))
    return hilbert_keys(np.clip(cells, 0, (1 << BITS) - 1))


def tokenised(docs: DataFrame, tokenizer: str = TOKENIZER, ranks: str = RANKS) -> DataFrame:
    """(doc_id, key, n, ids) per row: curve key, number of ids with the end mark, the ids."""
    end = np.asarray([END_ID], dtype="<u2").tobytes()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(tokenizer, ranks)
        for batch in batches:
            ids = [data + end for data in encoder.encode([text or "" for text in batch["text"]])]
            vectors = np.array([document_vector(np.frombuffer(i, "<u2")) for i in ids])
            yield pd.DataFrame({
                "doc_id": batch["doc_id"],
                "key": curve_keys(vectors) if len(ids) else [],
                "n": [len(i) // 2 for i in ids],
                "ids": ids,
            })

    return docs.select("doc_id", "text").mapInPandas(
        encode, "doc_id long, key long, n long, ids binary"
    )


def _places(lengths: DataFrame) -> DataFrame:
    """(row, place): number of ids before each row, in the order of key, doc_id, row."""
    order = ("key", "doc_id", "row")

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            sums = batch["n"].cumsum() + before
            yield pd.DataFrame({"row": batch["row"], "part": part,
                                "inside": sums - batch["n"], "n": batch["n"]})
            before = int(sums.iloc[-1]) if len(sums) else before

    added = settle(
        lengths.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
            add_up, "row long, part int, inside long, n long"
        ),
        "pack-places",
    )
    # One row per partition of the sort.
    sums = added.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return added.join(bases, "part").select("row", (F.col("base") + F.col("inside")).alias("place"))


def sequence_starts(total: int, length: int) -> np.ndarray:
    """Where the sequences begin that follow the full ones: the rest, in powers of two."""
    at, rest, starts = total // length * length, total % length, []
    for bit in range(length.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            starts.append(at)
            at += 1 << bit
    return np.array(starts, dtype=np.int64)


def pack(docs: DataFrame, length: int = LENGTH, with_ids: bool = True,
         tokenizer: str = TOKENIZER, ranks: str = RANKS) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    and the piece's ids (16 bits each) if asked for.

    All sequences are full but the last ids: these fill sequences of powers of two.
    """
    with arrow_batches(docs.sparkSession, 1000):
        table = settle(
            tokenised(docs, tokenizer, ranks).withColumn("row", F.monotonically_increasing_id()),
            "pack-ids",
        )
    total = table.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    full, tail = total // length, sequence_starts(total, length)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            columns: list[tuple] = []
            for doc, data, place in zip(batch["doc_id"], batch["ids"], batch["place"], strict=True):
                ids = np.frombuffer(data, "<u2")
                end = place + len(ids)
                cuts = np.arange((place // length + 1) * length, min(end, full * length + 1), length)
                edges = np.unique(np.concatenate(
                    ([place, end], cuts[cuts < end], tail[(tail > place) & (tail < end)])
                )).astype(np.int64)
                for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    piece = ids[low - place : high - place]
                    if low < full * length:
                        sequence, offset = divmod(low, length)
                    else:
                        last = int(np.searchsorted(tail, low, "right")) - 1
                        sequence, offset = full + last, low - int(tail[last])
                    columns.append((doc, low - place, high - low,
                                    zlib.crc32(piece.astype("<u4").tobytes()), len(ids),
                                    sequence, offset, piece.tobytes() if with_ids else None))
            frame = pd.DataFrame(columns, columns=names)
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame if with_ids else frame.drop(columns="ids")

    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long")
    names = [part.split()[0] for part in schema.split(", ")] + ["ids"]
    places = _places(table.select("row", "doc_id", "key", "n"))
    return table.select("row", "doc_id", "ids").join(places, "row").select(
        "doc_id", "ids", "place"
    ).mapInPandas(cut, schema + ", ids binary" if with_ids else schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the pieces of each sequence put together in their order.

    A sequence has at most as many ids as it is long, so a group is small.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return pieces.groupBy("sequence_id").agg(
        F.unhex(F.array_join(F.transform(ordered, lambda p: p["ids"]), "")).alias("ids")
    )
