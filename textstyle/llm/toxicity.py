"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of the sum of
its words' weights, each the mean of the weights of the word and its character n-grams,
hashed; the document's is the noisy-or of its sentences: it is clean only if all of them
are. The weights are learned from document labels by gradient descent in numpy, through
the noisy-or, on a bounded sample. Sentences that reach the limit are the offending ones.

Sample: at most ``PER_CLASS`` documents of each label. All other documents are only scored,
whole. Rows: NULL, empty and wordless texts have no sentence and score 0; repeated rows and
ids have equal scores. Without labels every score comes from the starting bias. Extra
columns pass through, those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textstyle.llm.common import fresh, key_mod
from textstyle.llm.subwords import (
    BUCKETS,
    Words,
    features,
    labelled_sample,
    of_words,
    vocabulary,
)

PER_CLASS = 2500
EPOCHS, BATCH, RATE, START = 12, 32, 0.5, -5.0
# What squared slopes start from: without it, a feature met once would take a full step.
FIRST = 1e-5
# A word's weight is the sum of its features' over their number to this power.
POWER = 0.5
FOLDS, HELD_OUT, LIMIT = 5, 0, 0.5
# Marks around words, marks that end a sentence, and a line's end.
MARKS = b".,;:!?\"'()[]{}*#$%&|-_<>=+/\\"
ENDS = (b".", b"!", b"?")
LINE_END = b"\x00"
# Texts whose new words are worked out together.
TOGETHER = 200
RESULTS = ("held_out", "score", "predicted", "offending")


def tokens(text: str) -> list[bytes]:
    """Words with their marks; line ends are tokens of their own."""
    return text.encode("utf-8", "surrogatepass").replace(b"\n", b" \x00 ").split()


def plain(token: bytes) -> bytes:
    return token.lower().strip(MARKS)


def closes(token: bytes) -> bool:
    return token == LINE_END or token.endswith(ENDS)


def sentence_numbers(ends: np.ndarray) -> np.ndarray:
    """Number of the sentence of each token, given which tokens end one."""
    return np.cumsum(ends) - ends


def once(sentence: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word once per sentence: a sentence is the set of its words."""
    both = np.unique(sentence << 32 | word)
    return both >> 32, both & 0xFFFFFFFF


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def train(texts: list[str], labels: np.ndarray, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weight of each bucket, and the bias of a sentence."""
    words = Words(lambda found: np.zeros((len(found), 1)), 1)
    docs = []
    for text in texts:
        found = tokens(text)
        ends = np.array([closes(t) for t in found], dtype=np.int64)
        numbers = words.numbers([plain(t) for t in found])
        sentence, word = once(sentence_numbers(ends), numbers)
        docs.append((word, sentence))
    parts, starts = vocabulary(words)
    random = np.random.default_rng(seed)
    weights, bias = np.zeros(BUCKETS), START
    seen, seen_bias = np.full(BUCKETS, FIRST), FIRST
    docs_left = np.array([len(numbers) > 0 for numbers, _ in docs], dtype=bool)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = random.permutation(np.flatnonzero(docs_left))
        for first in range(0, len(order), BATCH):
            batch = order[first : first + BATCH]
            used, word = np.unique(
                np.concatenate([docs[d][0] for d in batch]), return_inverse=True
            )
            sizes = np.array([docs[d][1][-1] + 1 for d in batch])
            base = np.cumsum(sizes) - sizes
            sentence = np.concatenate([docs[d][1] + b for d, b in zip(batch, base, strict=True)])
            owner = np.repeat(np.arange(len(batch)), sizes)
            place, counts = of_words(used, starts)
            bucket, of_word = parts[place], np.repeat(np.arange(len(used)), counts)
            share = counts**POWER
            value = np.bincount(of_word, weights[bucket], len(used)) / share
            z = bias + np.bincount(sentence, value[word], len(owner))
            total = np.bincount(owner, softplus(z), len(batch))
            # Slope of the loss in the sum of the sentences' log-complements.
            slope = np.where(
                labels[batch] == 1, -np.exp(-total) / np.maximum(-np.expm1(-total), 1e-12), 1.0
            )
            dz = slope[owner] / (1 + np.exp(-np.maximum(z, -500))) / len(batch)
            dword = np.bincount(word, dz[sentence], len(used)) / share
            grad = np.bincount(bucket, dword[of_word], BUCKETS)
            on = np.flatnonzero(grad)
            seen[on] += grad[on] ** 2
            weights[on] -= rate * grad[on] / np.sqrt(seen[on])
            seen_bias += dz.sum() ** 2
            bias -= rate * dz.sum() / np.sqrt(seen_bias)
    return weights.astype(np.float32), float(bias)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS,
        held_out: int = HELD_OUT, per_class: int = PER_CLASS) -> tuple[np.ndarray, float]:
    """The model of a bounded sample, trained in one task."""
    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample = pd.concat([pd.DataFrame({"doc_id": [], "text": [], "label": []}), *batches])
        if len(sample):
            sample = sample.sort_values(["doc_id", "text"]).drop_duplicates()
            weights, bias = train(sample["text"].tolist(), sample["label"].to_numpy(np.int64))
            yield pd.DataFrame({"weights": [weights.tobytes()], "bias": [bias]})

    sample = labelled_sample(docs, labels, label, folds, held_out, per_class)
    model = sample.repartition(1).mapInPandas(learn, "weights binary, bias double").collect()
    if not model:
        return np.zeros(BUCKETS, np.float32), START
    return np.frombuffer(model[0]["weights"], np.float32), model[0]["bias"]


class Scorer:
    def __init__(self, weights: np.ndarray, bias: float, limit: float = LIMIT):
        def work_out(found: list[bytes]) -> np.ndarray:
            bucket, owner = features([plain(token) for token in found])
            sums = np.bincount(owner, weights[bucket], len(found))
            counts = np.bincount(owner, minlength=len(found))
            return np.stack([sums / counts**POWER, [closes(token) for token in found]], axis=1)

        self.words, self.bias, self.limit = Words(work_out, 2), bias, limit

    def documents(self, texts: list[str]) -> list[tuple[float, list[str]]]:
        """Each document's score and its offending sentences."""
        self.words.room()
        numbered = [self.words.numbers(tokens(text)) for text in texts]
        values = self.words.values()
        return [self._one(text, numbers, values)
                for text, numbers in zip(texts, numbered, strict=True)]

    def _one(self, text: str, numbers: np.ndarray, values: np.ndarray) -> tuple[float, list[str]]:
        if not len(numbers):
            return 0.0, []
        sentence = sentence_numbers(values[numbers, 1].astype(np.int64))
        of_word, word = once(sentence, numbers)
        z = self.bias + np.bincount(of_word, values[word, 0])
        total = float(softplus(z).sum())
        result = float(-np.expm1(-total))
        if result < self.limit:
            return result, []
        # Where several sentences share the blame, the likeliest one is named.
        guilty = np.flatnonzero(z >= min(np.log(self.limit / (1 - self.limit)), z.max()))
        found, offending = tokens(text), []
        for number in guilty:
            first, end = np.searchsorted(sentence, [number, number + 1])
            kept = [t for t in found[first:end] if t != LINE_END]
            offending.append(b" ".join(kept).decode("utf-8", "replace"))
        return result, offending


def score(docs: DataFrame, labels: DataFrame, limit: float = LIMIT, **settings) -> DataFrame:
    """Every row with held_out, score, predicted and its offending sentences."""
    weights, bias = fit(docs, labels, **settings)
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    own = docs.drop(*RESULTS)
    (found_here,) = fresh(own, "found_here")

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(sent.value, bias, limit)
        for batch in batches:
            texts = batch.fillna("").tolist()
            found = [one for i in range(0, len(texts), TOGETHER)
                     for one in scorer.documents(texts[i : i + TOGETHER])]
            yield pd.DataFrame({"score": [s for s, _ in found], "offending": [o for _, o in found]})

    scored = F.pandas_udf(run, "score double, offending array<string>")(F.col("text"))
    held = key_mod("doc_id", settings.get("folds", FOLDS)) == settings.get("held_out", HELD_OUT)
    return (
        own.withColumn("held_out", held)
        .withColumn(found_here, scored)
        .select(
            *own.columns, "held_out", F.col(found_here)["score"].alias("score"),
            (F.col(found_here)["score"] >= limit).cast("int").alias("predicted"),
            F.col(found_here)["offending"].alias("offending"),
        )
    )
