"""Quality by supervised subword embeddings.

A document's vector is the average of the learned vectors of its words, hashed, and of
their character n-grams; a softmax over the classes follows. A word that repeats the one
before it adds a feature of its own. Training is stochastic gradient descent in numpy over
a bounded sample of labelled documents. Since the softmax is linear in the average, a
bucket's vector shrinks to one number for scoring.

Sample: at most ``PER_CLASS`` documents of each label. All other documents are only scored,
whole. Rows: NULL and empty texts have the score of the bias alone; repeated rows and ids
have equal scores. Without labels every score is 0.5; with labels of one class the classifier
learns that class. Extra columns pass through, those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textstyle.llm.common import key_mod
from textstyle.llm.subwords import (
    BUCKETS,
    Words,
    features,
    labelled_sample,
    of_words,
    vocabulary,
)

PER_CLASS = 2500
DIMENSIONS, EPOCHS, BATCH, RATE = 8, 5, 32, 0.3
FOLDS, HELD_OUT, LIMIT = 4, 2, 0.7
# Texts whose new words are worked out together.
TOGETHER = 200
# The feature of a word that repeats the one before it.
REPEATED = b" repeated"
RESULTS = ("held_out", "score", "predicted")


def tokens(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def train(texts: list[str], labels: np.ndarray, seed: int = 1) -> tuple[np.ndarray, float]:
    """One number per bucket and a bias: their average plus bias is the log-odds of label 1."""
    words = Words(lambda found: np.zeros((len(found), 1)), 1)
    docs = []
    for text in texts:
        numbers = words.numbers(tokens(text))
        again = int((numbers[1:] == numbers[:-1]).sum())
        if again:
            numbers = np.append(numbers, np.full(again, words[REPEATED]))
        docs.append(np.unique(numbers, return_counts=True))
    parts, starts = vocabulary(words)
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    output, bias = np.zeros((2, DIMENSIONS)), np.zeros(2)
    seen, seen_output = np.full(BUCKETS, 1e-8), np.full((2, DIMENSIONS), 1e-8)
    steps = EPOCHS * -(-len(docs) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(docs))
        for first in range(0, len(order), BATCH):
            batch = order[first : first + BATCH]
            owner = np.repeat(np.arange(len(batch)), [len(docs[d][0]) for d in batch])
            place, counts = of_words(np.concatenate([docs[d][0] for d in batch]), starts)
            weight = np.repeat(np.concatenate([docs[d][1] for d in batch]), counts).astype(float)
            owner = np.repeat(owner, counts)
            weight /= np.maximum(np.bincount(owner, weight, len(batch)), 1)[owner]
            bucket = parts[place]
            used, local = np.unique(bucket, return_inverse=True)
            mean = np.stack([
                np.bincount(owner, weight * vectors[bucket, d], len(batch))
                for d in range(DIMENSIONS)
            ], axis=1)
            logits = mean @ output.T + bias
            chance = np.exp(logits - logits.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            chance[np.arange(len(batch)), labels[batch]] -= 1
            slope = chance @ output
            grad = np.stack([
                np.bincount(local, weight * slope[owner, d], len(used)) for d in range(DIMENSIONS)
            ], axis=1)
            grad_output = chance.T @ mean
            rate = RATE * (1 - step / steps)
            step += 1
            seen[used] += (grad**2).mean(axis=1)
            vectors[used] -= rate * grad / np.sqrt(seen[used])[:, None]
            seen_output += grad_output**2
            output -= rate * grad_output / np.sqrt(seen_output)
            bias -= rate * chance.mean(axis=0)
    return (vectors @ (output[1] - output[0])).astype(np.float32), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS,
        held_out: int = HELD_OUT, per_class: int = PER_CLASS) -> tuple[np.ndarray, float]:
    """The model of a bounded sample, trained in one task."""
    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample = pd.concat([pd.DataFrame({"doc_id": [], "text": [], "label": []}), *batches])
        if len(sample):
            # Rows in a fixed order: the model depends on the sample alone.
            sample = sample.sort_values(["doc_id", "text"]).drop_duplicates()
            weights, bias = train(sample["text"].tolist(), sample["label"].to_numpy(np.int64))
            yield pd.DataFrame({"weights": [weights.tobytes()], "bias": [bias]})

    sample = labelled_sample(docs, labels, label, folds, held_out, per_class)
    model = sample.repartition(1).mapInPandas(learn, "weights binary, bias double").collect()
    if not model:
        return np.zeros(BUCKETS, np.float32), 0.0
    return np.frombuffer(model[0]["weights"], np.float32), model[0]["bias"]


def scores(texts: list[str], weights: np.ndarray, bias: float, words: Words) -> np.ndarray:
    words.room()
    repeated = weights[features([REPEATED])[0]]
    found = [words.numbers(tokens(text)) for text in texts]
    values = words.values()
    logits = np.empty(len(texts))
    for place, numbers in enumerate(found):
        again = int((numbers[1:] == numbers[:-1]).sum())
        total, count = values[numbers].sum(axis=0)
        total, count = total + again * repeated.sum(), count + again * len(repeated)
        logits[place] = bias + total / max(count, 1)
    return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))


def word_sums(weights: np.ndarray) -> Words:
    """Of each word, the sum of its features' weights and their number."""
    def work_out(found: list[bytes]) -> np.ndarray:
        bucket, owner = features(found)
        return np.stack([np.bincount(owner, weights[bucket], len(found)),
                         np.bincount(owner, minlength=len(found))], axis=1)

    return Words(work_out, 2)


def score(docs: DataFrame, labels: DataFrame, limit: float = LIMIT, **settings) -> DataFrame:
    """Every row with held_out, score and predicted."""
    weights, bias = fit(docs, labels, **settings)
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    own = docs.drop(*RESULTS)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = sent.value

        words = word_sums(model)
        for batch in batches:
            texts = batch.fillna("").tolist()
            parts = [scores(texts[i : i + TOGETHER], model, bias, words)
                     for i in range(0, len(texts), TOGETHER)]
            yield pd.Series(np.concatenate(parts) if parts else [], dtype="float64")

    scorer = F.pandas_udf(run, "double")
    held = key_mod("doc_id", settings.get("folds", FOLDS)) == settings.get("held_out", HELD_OUT)
    return (
        own.withColumn("held_out", held)
        .withColumn("score", scorer(F.col("text")))
        .withColumn("predicted", (F.col("score") >= limit).cast("int"))
    )
