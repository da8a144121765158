"""Document readability and its averages by author and genre."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textstyle.functions.scores import (
    average_sentence_length,
    flesch,
    kandel_moles,
    readability_band,
)
from textstyle.functions.syllables import text_syllables
from textstyle.operators.annotate import annotated


def document_metrics(corpus: DataFrame, hyphens: str = "count") -> DataFrame:
    """Add word, sentence and syllable counts and both scores; annotations are dropped.

    Syllables that ``with_windows`` has counted on the way are taken from there.
    """
    known = f"_syllables_{hyphens}"
    counted = annotated(corpus).withColumns(
        {
            "word_count": F.size("tokens"),
            "sentence_count": F.size("sentences"),
            "syllable_count": F.col(known) if known in corpus.columns
            else text_syllables("tokens", hyphens),
        }
    ).drop(known)
    counts = ("word_count", "sentence_count", "syllable_count")
    return counted.drop("tokens", "sentences").withColumns(
        {"flesch_score": flesch(*counts), "km_score": kandel_moles(*counts)}
    )


def add_up_blocks(blocks: DataFrame, hyphens: str = "count") -> DataFrame:
    """``document_metrics`` of documents stored as several rows per id (chapters, turns).

    Counts are summed with partial aggregation; no document is ever put together. The end
    of a block ends its sentence.
    """
    counted = document_metrics(blocks.select("id", "author", "genre", "text"), hyphens)
    counts = ("word_count", "sentence_count", "syllable_count")
    summed = counted.groupBy("id", "author", "genre").agg(
        *[F.sum(name).alias(name) for name in counts]
    )
    return summed.withColumns(
        {"flesch_score": flesch(*counts), "km_score": kandel_moles(*counts)}
    )


def author_stats(metrics: DataFrame) -> DataFrame:
    """Unweighted means over the documents of each author and genre."""
    return metrics.groupBy("author", "genre").agg(
        F.avg("flesch_score").alias("avg_flesch"),
        F.avg("km_score").alias("avg_km"),
        F.avg("word_count").alias("avg_words"),
        F.avg("sentence_count").alias("avg_sentences"),
    )


def complexity_by_author(books: DataFrame) -> DataFrame:
    """Mean sentence and word counts; groups without a mean are dropped."""
    means = books.groupBy("author", "genre").agg(
        F.avg("sentence_count").alias("avg_sentences"), F.avg("word_count").alias("avg_words")
    )
    return means.na.drop(subset=["avg_words", "avg_sentences"])


def book_projection(metrics: DataFrame) -> DataFrame:
    """The per-book columns charts are drawn from."""
    return metrics.select(
        "id", "title", "author", "genre", "word_count", "sentence_count", "flesch_score",
        "km_score",
        average_sentence_length("word_count", "sentence_count").alias("avg_sent_len"),
    )


def with_band(table: DataFrame, score: str = "flesch_score") -> DataFrame:
    return table.withColumn("band", readability_band(score))
