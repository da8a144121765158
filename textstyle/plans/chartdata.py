"""Tables behind the charts and summaries. Sorting happens only here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textstyle.functions.scores import readability_band
from textstyle.operators.corpus import only_documents, summary_columns
from textstyle.operators.dialogue import column_means, dialogue_stats
from textstyle.operators.lexical import (
    representative_documents,
    representative_words,
    words_of_representatives,
)
from textstyle.operators.readability import (
    author_stats,
    with_band,
)
from textstyle.operators.windows import first_document_windows
from textstyle.sources import tables

# Display names of the author summary.
SUMMARY_NAMES = {
    "author": "Auteur",
    "genre": "Genre",
    "avg_flesch": "Flesch moy.",
    "avg_km": "KM moy.",
    "avg_words": "Mots moy.",
    "avg_sentences": "Phrases moy.",
}


def flesch_bars(metrics: DataFrame) -> DataFrame:
    """Mean Flesch score of each author and genre with its band."""
    stats = author_stats(metrics).select("author", "genre", "avg_flesch")
    return stats.withColumn("band", readability_band("avg_flesch"))


def kandel_moles_bars(metrics: DataFrame) -> DataFrame:
    return author_stats(metrics).select("author", "genre", "avg_km")


def band_counts(metrics: DataFrame) -> DataFrame:
    """Documents per genre and readability band."""
    return with_band(metrics).groupBy("genre", "band").agg(F.count(F.lit(1)).alias("documents"))


def author_summary(metrics: DataFrame) -> DataFrame:
    return summary_columns(author_stats(metrics), SUMMARY_NAMES)


def first_documents(windows: DataFrame, window_size: int = 500) -> DataFrame:
    """Smallest document id of each author among those with windows of this size."""
    sized = windows.filter(F.col("window_size") == window_size)
    return sized.groupBy("author").agg(F.min("id").alias("id"))


def window_curves(windows: DataFrame, window_size: int = 500) -> DataFrame:
    """Windows in reading order, one document per author given."""
    sized = windows.filter(F.col("window_size") == window_size)
    return sized.orderBy("author", "window_index")


def corpus_curves(corpus: DataFrame, window_size: int = 500, step: int = 250) -> DataFrame:
    """The same curves straight from a corpus."""
    return window_curves(first_document_windows(corpus, window_size, step), window_size)


def sample_curves(windows: DataFrame, window_size: int = 500) -> DataFrame:
    """Windows of the first document of each author, from a stored window table."""
    chosen = first_documents(windows, window_size)
    return window_curves(only_documents(windows, chosen), window_size)


def characteristic_words(zipf: DataFrame, head: int = 50) -> DataFrame:
    """Most frequent words of one document per author, from a stored word table."""
    chosen = only_documents(zipf, representative_documents(zipf))
    return representative_words(chosen, head).orderBy(F.desc("frequency"), "author", "word")


def corpus_characteristic_words(corpus: DataFrame, head: int = 50) -> DataFrame:
    """The same words straight from a corpus."""
    words = words_of_representatives(corpus, head)
    return words.orderBy(F.desc("frequency"), "author", "word")


def stored_dialogue(spark: SparkSession, folder: str) -> DataFrame | None:
    """The dialogue table below ``folder``: the stored CSV if there is one, else the means of
    all columns of the stored annotated corpus that tell of dialogue, None without any."""
    stored = tables.read_csv(spark, f"{folder}/{tables.SEGMENTATION}", tables.SEGMENTATION_SCHEMA)
    if stored is not None:
        return stored
    corpus = tables.if_present(lambda: spark.read.parquet(f"{folder}/{tables.ANNOTATED_CORPUS}"))
    if corpus is None or not any("dialog" in name for name in corpus.columns):
        return None
    return column_means(corpus)


def dialogue_bars(counted: DataFrame) -> DataFrame:
    return dialogue_stats(counted).select("author", "genre", "avg_dialog_ratio")
