"""Abbreviations against the method in plain Python, and the sentences they leave whole."""

import math
import random
import re
from collections import Counter

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from textstyle.functions.text import sentences
from textstyle.operators import abbreviations
from textstyle.operators.abbreviations import (
    abbreviation_scores,
    learn_abbreviations,
    sentences_but,
    stop_counts,
    stored_counts,
    with_sentences,
)
from textstyle.plans import registry


def plain_scores(texts):
    with_stop, without = Counter(), Counter()
    for text in texts:
        for found in re.findall(r"[^\W_]+(?:[.'’\-]+[^\W_]+)*\.*", (text or "").lower()):
            word = found.rstrip(".")
            if re.search(r"[^\W\d_]", word):
                (with_stop if len(found) - len(word) == 1 else without)[word] += 1
    stops, words = sum(with_stop.values()), sum((with_stop + without).values())
    scores = {}
    for word, n in with_stop.items():
        def likelihood(chance, word=word, n=n):
            return n * math.log(chance) + (
                without[word] * math.log(1 - chance) if without[word] else 0)

        ratio = -2 * (likelihood(stops / words) - likelihood(0.99))
        letters = len(word.replace(".", "")) + 1
        scores[word] = ratio * math.exp(-letters) * (word.count(".") + 1) * letters ** -float(
            without[word])
    return with_stop, without, scores


@pytest.fixture
def texts():
    pick = random.Random(2)
    names = ["Dupont", "Durand", "Sand"]
    made = []
    for _ in range(60):
        words = [pick.choice(["le chat dort", "M. " + pick.choice(names) + " rit", "c.-à-d. rien",
                              "il part... loin", "No 3. est là", "etc. encore"])
                 for _ in range(pick.randrange(1, 9))]
        made.append(". ".join(words) + ".")
    return [*made, None, "", "...", "3.5", "M.", "été. ÉTÉ. été"]


def test_scores_equal_plain_python(make_corpus, texts):
    with_stop, without, scores = plain_scores(texts)
    counts = stop_counts(make_corpus(*texts))
    assert {r.word: (r.with_stop, r.without_stop) for r in counts.collect()} == {
        w: (with_stop[w], without[w]) for w in with_stop + without}
    found = {r.word: r.score for r in abbreviation_scores(counts).collect()}
    assert found == {w: pytest.approx(s, rel=1e-9) for w, s in scores.items()}


def test_learned_abbreviations_end_no_sentence(spark, make_corpus, texts):
    learned = learn_abbreviations(make_corpus(*texts))
    assert {"m", "etc"} <= set(learned) and "il" not in learned
    scores = plain_scores(texts)[2]
    assert set(learned) == {word for word, score in scores.items() if score >= 0.3}
    assert learn_abbreviations(make_corpus(*texts), most=1)[0] in learned
    assert learn_abbreviations(make_corpus("", None)) == []
    table = spark.createDataFrame(
        [("M. Dupont rit. Elle, etc. part!  Fin",), ("M... Non. m. Oui",), ("Il dit M.",), (None,),
         ("",), (". . M. .",), ("a\x01b. C",)], "text string")
    rows = table.select(sentences_but("text", ["m", "etc"]).alias("s")).collect()
    assert [r.s for r in rows] == [
        ["M. Dupont rit", "Elle, etc. part", "Fin"], ["M", "Non", "m. Oui"], ["Il dit M."], [], [],
        ["M. "], ["a b", "C"]]


def test_without_abbreviations_nothing_changes(make_corpus, texts):
    corpus = make_corpus(*texts, "Un! Deux?? Trois… quatre.cinq\nsix. ", "?!", "a.\n\nb")
    same = corpus.select(sentences("text").alias("a"), sentences_but("text", []).alias("b"))
    assert same.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_texts_are_counted_once(make_corpus, texts):
    counts = stop_counts(make_corpus(*texts))
    # No sorting of words inside the rows: tasks add up what they find.
    assert "sort_array" not in plan_of(counts) and "partial_count" in plan_of(counts)
    stored = stored_counts(make_corpus(*texts))
    assert sorted(stored.collect()) == sorted(counts.collect())
    # The scores read the written counts, for their sums and for their rows.
    assert "regexp_extract_all" not in plan_of(abbreviation_scores(stored))


def test_last_words_behind_odd_spaces(spark):
    table = spark.createDataFrame(
        [("a\u00a0M. B. c",), ("x\nM.\t\nB",), ("(etc.) M.\r\n",), ("d'etc. B. l-m. C",),
         (" M. ",)], "text string")
    rows = table.select(sentences_but("text", ["m", "etc", "d'etc"]).alias("s")).collect()
    assert [r.s for r in rows] == [
        ["a\u00a0M. B", "c"], ["x\nM.\t\nB"], ["(etc.) M.\r\n"], ["d'etc. B", "l-m", "C"], [" M. "]]


def test_all_abbreviations_count(spark, tmp_path):
    """More of them than a plan holds: none is left out."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [f"{a}.{b}.{c}" for a in letters for b in letters for c in letters][:6_000]
    rows = [(i, f"Le {name}. Dit " + "mot " * 60 + "mot. Fin", "s", "fr", 1)
            for i, name in enumerate(names)]
    spark.createDataFrame(
        rows, "doc_id long, text string, source string, lang string, n_chars long"
    ).write.parquet(f"{tmp_path}/documents.parquet")
    assert len(learn_abbreviations(registry.documents(spark, str(tmp_path)))) == len(names)
    found = registry.abbreviation_sentences(spark, str(tmp_path))
    by_id = found.groupBy("id").agg(F.count("*").alias("n"), F.min_by("length", "number").alias("l"))
    assert {(r.n, r.l) for r in by_id.collect()} == {(2, len("Le a.b.c. Dit ") + 60 * 4 + 3)}
    assert by_id.count() == len(names)


def test_listed_and_joined_abbreviations_agree(spark, monkeypatch, texts):
    odd = ["M. Dupont rit. Elle, etc. part!  Fin", "M... Non. m. Oui", "Il dit M.", ". . M. .",
           "a\x01b. C", "M. etc. M. etc.", "?!", "a.\n\nb", " M. ", "M.! etc.\r\n"]
    rows = [(i % 7 or None, text) for i, text in enumerate([*texts, *odd, *odd])]
    table = spark.createDataFrame(rows, "id long, text string").repartition(5)
    words = spark.createDataFrame([("m",), ("etc",), ("c.-à-d",), ("no",)], "word string")
    listed = with_sentences(table, words)
    monkeypatch.setattr(abbreviations, "LISTED", 1)
    joined = with_sentences(table, words)
    assert joined.columns == listed.columns == ["id", "text", "found"]
    assert sorted(joined.collect(), key=repr) == sorted(listed.collect(), key=repr)
