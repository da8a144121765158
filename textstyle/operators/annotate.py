"""Annotation: sentence and token arrays next to each text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textstyle.functions.syllables import token_syllables
from textstyle.functions.text import sentences, tokens


def annotate(corpus: DataFrame, words_only: bool = False) -> DataFrame:
    """Add ``sentences`` and ``tokens`` (both ``array<string>``)."""
    return corpus.withColumns(
        {"sentences": sentences("text"), "tokens": tokens("text", words_only)}
    )


def annotated(corpus: DataFrame) -> DataFrame:
    """The frame itself when it already holds tokens, else its annotation."""
    return corpus if "tokens" in corpus.columns else annotate(corpus)


def exploded_tokens(corpus: DataFrame) -> DataFrame:
    """One row per token, without its position.

    The generator reads an expression, not a bare column: on a bare column
    Spark would add a ``size(...) > 0`` filter and tokenise every text twice.
    """
    rows = F.transform("tokens", lambda word: F.struct(word.alias("word")))
    return annotated(corpus).select("id", "author", "genre", "title", F.inline(rows))


def token_table(corpus: DataFrame, hyphens: str = "count") -> DataFrame:
    """One row per token: position in the document, token and its syllables."""
    counted = annotated(corpus).select(
        "id", "author", "genre", "title", "tokens",
        token_syllables("tokens", hyphens).alias("_syllables"),
    )
    rows = F.transform(
        "tokens",
        lambda word, pos: F.struct(
            pos.alias("pos"), word.alias("word"), F.get("_syllables", pos).alias("syllables")
        ),
    )
    return counted.select("id", "author", "genre", "title", F.inline(rows))
