"""Readability formulas and the small statistics built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textstyle.functions.text import _col

# Fixed values: (constant, weight of words per sentence, weight of syllables per word).
FLESCH = (206.835, 1.015, 84.6)
KANDEL_MOLES = (207.0, 1.015, 73.6)

# Scores above EASY are easy, below HARD hard, otherwise medium.
EASY = 70
HARD = 30


def _score(weights, words, sentences, syllables) -> Column:
    constant, per_sentence, per_word = weights
    words, sentences, syllables = _col(words), _col(sentences), _col(syllables)
    score = (
        F.lit(constant)
        - F.lit(per_sentence) * (words / sentences)
        - F.lit(per_word) * (syllables / words)
    )
    return F.when((words == 0) | (sentences == 0), F.lit(0.0)).otherwise(score)


def flesch(words, sentences, syllables) -> Column:
    """Flesch reading ease; 0.0 without words or sentences."""
    return _score(FLESCH, words, sentences, syllables)


def kandel_moles(words, sentences, syllables) -> Column:
    """Kandel-Moles reading ease; 0.0 without words or sentences."""
    return _score(KANDEL_MOLES, words, sentences, syllables)


def readability_band(score: Column | str) -> Column:
    score = _col(score)
    return F.when(score > EASY, "easy").when(score < HARD, "hard").otherwise("medium")


def average_sentence_length(words: Column | str, sentences: Column | str) -> Column:
    return _col(words) / F.greatest(_col(sentences), F.lit(1))


def variation(deviation: Column | str, mean: Column | str) -> Column:
    """Coefficient of variation, safe for a mean of zero."""
    return _col(deviation) / F.greatest(F.abs(_col(mean)), F.lit(1e-9))
