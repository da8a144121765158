"""Words as hashed features, and bounded labelled samples, for the trained classifiers."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textstyle.llm.common import key_mod, settle

BUCKETS = 1 << 18
# Lengths of the character n-grams, counted in bytes of the word between its brackets.
SHORTEST, LONGEST = 3, 5
# Parts in which the documents of a label are ranked.
PARTS = 64
# Words whose weights a worker keeps.
CACHED = 400_000


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and their character n-grams, and the place of each one's word.

    The n-grams of all words are hashed side by side: each length from the one before.
    """
    framed = [b"<" + word + b">" for word in words]
    lengths = np.fromiter(map(len, framed), np.int64, len(framed))
    text = np.frombuffer(b"".join(framed), np.uint8).astype(np.uint32)
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(text))
    buckets = [np.fromiter(map(crc32, framed), np.uint32, len(framed))]
    owners = [np.arange(len(words))]
    hashed = np.zeros(len(text), np.uint32)
    for n in range(1, LONGEST + 1):
        hashed = hashed[: max(len(text) - n + 1, 0)] * np.uint32(16777619) + text[n - 1 :]
        if n >= SHORTEST:
            fits = left[: len(hashed)] >= n
            mixed = hashed[fits] + np.uint32(n)
            mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            buckets.append(mixed ^ (mixed >> np.uint32(13)))
            owners.append(owner[: len(hashed)][fits])
    return (np.concatenate(buckets) & np.uint32(BUCKETS - 1)).astype(np.int64), np.concatenate(owners)


class Words(dict):
    """Number of each word met, with values worked out once, for many words together.

    ``work_out`` gives a row of ``width`` values for each of a list of words. Call ``room``
    between texts whose numbers are no longer needed: it forgets everything once more than
    ``CACHED`` words are known.
    """

    def __init__(self, work_out: Callable[[list[bytes]], np.ndarray], width: int):
        super().__init__()
        self.work_out, self.width = work_out, width
        self.known, self.waiting = np.zeros((0, width)), []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.waiting.append(word)
        return number

    def room(self) -> None:
        if len(self) > CACHED:
            self.clear()
            self.known, self.waiting = np.zeros((0, self.width)), []

    def numbers(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))

    def values(self) -> np.ndarray:
        if self.waiting:
            self.known = np.concatenate([self.known, self.work_out(self.waiting)])
            self.waiting = []
        return self.known


def vocabulary(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Features of all words that have a number, by number, and where each word's begin."""
    buckets, owner = features(list(words))
    order = np.argsort(owner, kind="stable")
    return buckets[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))])


def of_words(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the features of ``words`` in the vocabulary's array, and their counts."""
    counts = starts[words + 1] - starts[words]
    first = np.repeat(starts[words] - (np.cumsum(counts) - counts), counts)
    return first + np.arange(counts.sum()), counts


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int,
                    per_class: int) -> DataFrame:
    """(text, label) of at most ``per_class`` documents of each label, those with the least
    hashes of their ids, none of them held out.

    Only ids and labels are ranked, in ``PARTS`` parts first, so that a label with most of the
    rows is not ranked by one task; every task keeps its best before they are shuffled.
    The labels of an id that has several are the larger one. An id may have any number of
    texts: of the chosen ids' texts, different ones, the first ``per_class`` are taken in the
    same way.
    """
    known = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()
                      & (key_mod("doc_id", folds) != held_out))
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    )
    def first(rows: DataFrame, *order: Column) -> DataFrame:
        part = F.pmod(F.xxhash64(*order), F.lit(PARTS))
        in_part = Window.partitionBy("label", part).orderBy(*order)
        overall = Window.partitionBy("label").orderBy(*order)
        for window in (in_part, overall):
            rows = rows.withColumn("place", F.row_number().over(window)).filter(
                F.col("place") <= per_class
            )
        return rows.drop("place")

    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = settle(first(known, *order), "labelled")
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = own.select("doc_id", F.xxhash64("text").alias("tag")).join(chosen, "doc_id").distinct()
    rows = settle(first(texts, *order, F.col("tag")), "labelled-rows")
    sample = own.withColumn("tag", F.xxhash64("text")).join(rows, ["doc_id", "tag"])
    return sample.dropDuplicates(["doc_id", "tag"]).select("doc_id", "text", "label")
