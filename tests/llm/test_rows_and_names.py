"""Rows that share an id or have none, columns that clash in name, and the classifiers' scores
against plain Python."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textstyle.llm import (
    language_model,
    line_dedup,
    mixing,
    near_dedup,
    quality,
    subwords,
    toxicity,
    url_filter,
)

DOCS = "doc_id long, text string, lang string, source string"
WORDS = " ".join(f"word{i}" for i in range(80))


def three_near(ids):
    """Three documents of one line, the second and third with one word changed."""
    return [(i, WORDS.replace("word7 ", new), "en", "s")
            for i, new in zip(ids, ("word7 ", "other ", "third "), strict=True)]


@pytest.mark.parametrize("ids", [(None, None, None), (1, 1, 1), (None, 4, 4), (3, 2, 1)])
def test_near_copies_are_found_whatever_their_ids(spark, ids):
    docs = spark.createDataFrame(three_near(ids), DOCS)
    lines = line_dedup.dedup_lines(docs).collect()
    assert sorted(r.n_kept for r in lines) == [0, 0, 1]
    assert near_dedup.drop_near(docs).count() == 1
    classes = {r.class_id for r in near_dedup.classify(docs).collect()}
    assert classes == {min((i for i in ids if i is not None), default=None)}


def test_the_first_line_in_the_order_of_ids_stays(spark):
    docs = spark.createDataFrame(three_near((3, 2, None)), DOCS)
    kept = {r.doc_id: r.n_kept for r in line_dedup.dedup_lines(docs).collect()}
    assert kept == {None: 1, 2: 0, 3: 0}


def test_a_sample_is_bounded_in_rows(spark):
    texts = spark.range(20_000).selectExpr("1 AS doc_id", "'text ' || id AS text")
    more = spark.range(2, 200).selectExpr("id AS doc_id", "'same' AS text")
    labels = spark.range(1, 200).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    sample = subwords.labelled_sample(texts.union(more).union(more), labels, "quality", 4, 2, 10)
    rows = sample.collect()
    assert all(n <= 10 for n in Counter(r.label for r in rows).values())
    assert len(set(rows)) == len(rows) > 10
    again = subwords.labelled_sample(
        texts.union(more).repartition(5), labels, "quality", 4, 2, 10).collect()
    assert sorted(again) == sorted(rows)


def test_documents_without_ids_are_drawn_one_by_one(spark):
    docs = spark.range(4000).selectExpr(
        "CAST(NULL AS LONG) AS doc_id", "'a b ' || id AS text",
        "CASE WHEN id % 2 = 0 THEN 'x' ELSE 'y' END AS source")
    rows = mixing.mix(docs).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken / r.target - 1) < 0.05 for r in rows)


NAMES = ("parts", "signs", "left_lines", "left", "places", "_doc", "_tag", "doc", "tag", "kept_lines",
         "kept_id", "kept_text", "kept_rows", "label", "first", "looked_up", "looked", "of_row",
         "found", "logs", "scored_url", "ruled", "toxicity_found", "found_here", "target_source",
         "of", "row", "Place", "token", "word", "count")


@pytest.mark.parametrize("apply", [
    mixing.mix,
    line_dedup.dedup_lines,
    near_dedup.drop_near,
    lambda d: toxicity.score(d, d.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS toxic")),
    lambda d: quality.score(d, d.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS quality")),
    language_model.score,
    lambda d: url_filter.judge(d.withColumnRenamed("text", "url")),
], ids=["mixing", "lines", "near", "toxicity", "quality", "language", "urls"])
def test_extra_columns_come_back_unchanged(spark, apply):
    docs = spark.createDataFrame([*three_near((1, 2, 3)), (4, None, None, None), (5, "x", "en", "t")],
                                 DOCS)
    mine = docs.select("*", *[F.concat(F.lit(n), "doc_id").alias(n) for n in NAMES])
    rows = apply(mine).collect()
    assert rows
    for r in rows:
        assert all(r[n] == f"{n}{r.doc_id}" for n in NAMES)


TEXTS = ["a bad word here. And a good one!\nbad bad Word", "", "   ", "bad", "fine text, fine (text)",
         "x " * 300 + "bad. end", "été\n\n.. !"]


def test_quality_scores_equal_plain_python():
    weights = np.random.default_rng(3).normal(size=subwords.BUCKETS).astype(np.float32)

    def parts(word):
        return [float(weights[b]) for b in subwords.features([word])[0]]

    expected = []
    for text in TEXTS:
        words = text.encode().split()
        values = [v for word in words for v in parts(word)]
        for word, before in zip(words[1:], words, strict=False):
            if word == before:
                values += parts(quality.REPEATED)
        expected.append(1 / (1 + math.exp(-(0.3 + sum(values) / max(len(values), 1)))))
    found = quality.scores(TEXTS, weights, 0.3, quality.word_sums(weights))
    assert found == pytest.approx(expected, rel=1e-5)


def test_toxicity_scores_and_sentences_equal_plain_python():
    weights = np.random.default_rng(4).normal(size=subwords.BUCKETS).astype(np.float32)
    bias = -2.0
    scorer = toxicity.Scorer(weights, bias)
    for text, (score, offending) in zip(TEXTS, scorer.documents(TEXTS), strict=True):
        sentences, words = [], []
        for token in text.encode().replace(b"\n", b" \x00 ").split():
            words.append(token)
            if token == b"\x00" or token[-1:] in (b".", b"!", b"?"):
                sentences.append(words)
                words = []
        if words:
            sentences.append(words)
        z = []
        for words in sentences:
            total = bias
            for word in set(words):
                buckets = subwords.features([toxicity.plain(word)])[0]
                total += sum(float(weights[b]) for b in buckets) / len(buckets) ** toxicity.POWER
            z.append(total)
        clean = math.prod(1 / (1 + math.exp(value)) for value in z)
        assert score == pytest.approx(1 - clean, rel=1e-4, abs=1e-6)
        if score < 0.5:
            assert offending == []
            continue
        limit = min(0.0, max(z))
        assert offending == [
            b" ".join(w for w in words if w != b"\x00").decode()
            for words, value in zip(sentences, z, strict=True) if value >= limit]
