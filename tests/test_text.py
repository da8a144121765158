import random
import re

import pytest
from pyspark.sql import functions as F

from textstyle.functions import dialogue, scores, syllables, text
from textstyle.operators.annotate import annotate, token_table
from textstyle.operators.readability import document_metrics

VOWELS = "aeiouyàâéèêëîïôùûü"
ALPHABET = "aeéèyùbcdfœŒÉÀ -'’.,!?…«»\"—\n\r\x0b\x0c\x1c\x1f\x85\xa0 ×1"


def random_texts(count=300, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, 40))) for _ in range(count)]


def column(spark, values, expression):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r.x for r in rows.select("i", expression.alias("x")).orderBy("i").collect()]


def runs(word):
    return len(re.findall(f"[{VOWELS}]+", word.lower()))


@pytest.mark.parametrize(
    "word, counted, ignored",
    [("peut-être", 4, 3), ("maison", 2, 2), (",", 1, 1), ("", 1, 1), ("cœur", 1, 1),
     ("-", 1, 1), ("Été", 2, 2)],
)
def test_syllable_fixtures(spark, word, counted, ignored):
    assert column(spark, [word], syllables.word_syllables("v")) == [counted]
    assert column(spark, [word], syllables.word_syllables("v", "ignore")) == [ignored]


def test_syllables_agree_with_plain_python(spark):
    words = [w.replace("\n", "") for w in random_texts()]
    assert column(spark, words, syllables.word_syllables("v", "ignore")) == [
        max(runs(w), 1) for w in words
    ]
    assert column(spark, words, syllables.word_syllables("v")) == [
        max(len(re.sub(f"[{VOWELS}]+", "-", w.lower()).split("-")) - 1, 1) for w in words
    ]


def test_unknown_hyphen_mode(spark):
    with pytest.raises(ValueError):
        syllables.word_syllables(F.lit("a"), "both")


def test_array_syllables_equal_word_syllables(spark, make_corpus):
    table = token_table(make_corpus(*random_texts(60)))
    assert table.count() > 0
    assert table.filter(F.col("syllables") != syllables.word_syllables("word")).count() == 0


def test_tokens_and_sentences(make_corpus):
    row = annotate(make_corpus("L'homme, peut-être, rit. Elle dort!")).first()
    assert row.tokens == ["L'homme", ",", "peut-être", ",", "rit", ".", "Elle", "dort", "!"]
    assert len(row.sentences) == 2
    assert annotate(make_corpus("Oui, non."), words_only=True).first().tokens == ["Oui", "non"]


@pytest.mark.parametrize(
    "value, expected",
    [("L'homme, peut-être, rit. Elle dort!", (9, 2, 14, 70.6675, 87.943611)),
     ("Un deux", (2, 1, 2, 120.205, 131.37)), ("", (0, 0, 0, 0.0, 0.0)),
     (None, (0, 0, 0, 0.0, 0.0))],
)
def test_document_metrics(make_corpus, value, expected):
    row = document_metrics(make_corpus(value)).first()
    found = (row.word_count, row.sentence_count, row.syllable_count, row.flesch_score,
             row.km_score)
    assert found == pytest.approx(expected, abs=1e-6)


def test_bands(spark):
    values = spark.createDataFrame([(70.1,), (70.0,), (30.0,), (29.9,)], "s double")
    found = [r.b for r in values.select(scores.readability_band("s").alias("b")).collect()]
    assert found == ["easy", "medium", "medium", "hard"]


def test_lines_equal_splitlines(spark):
    texts = ["", "\n", "a\r\nb\n\n", "a\n\rb", *random_texts()]
    assert column(spark, texts, text.lines("v")) == [t.splitlines() for t in texts]


def test_dialogue_test_agrees_with_plain_python(spark):
    def spoken(line):
        stripped = line.strip()
        return bool(stripped) and (
            stripped[0] in '«"„—–-' or re.search(r'[«"][^»"]*[»"]', stripped) is not None
        )

    lines = [line for t in random_texts(600) for line in t.splitlines()]
    assert any(spoken(line) for line in lines)
    assert column(spark, lines, dialogue.is_dialogue("v")) == [spoken(line) for line in lines]


def test_normalised_words(spark):
    values = ["L'homme", "cœur", "ÉTÉ", "a×b", "1", "ŒUVRE"]
    assert column(spark, values, text.normalise_word("v")) == [
        "lhomme", "cur", "été", "a×b", "", "uvre"
    ]
