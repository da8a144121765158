"""Adding books to stored tables without reading the ones that are there.

Every batch is a partition of the tables of texts, windows and words, and of tables of
mergeable states by author. Means and deviations are made from the states of all batches; texts
of earlier batches are never opened. A batch that is run again replaces its own partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from textstyle.functions.scores import variation
from textstyle.operators.annotate import annotate
from textstyle.operators.dialogue import add_segmentation
from textstyle.operators.lexical import expand_ranked_words, with_ranked_words
from textstyle.operators.moments import deviation, mean, merge, states
from textstyle.operators.readability import document_metrics
from textstyle.operators.windows import DEFAULT_CONFIGS, expand_windows, with_windows
from textstyle.sources import tables

AUTHOR_STATES = "parquet/author_states"
WINDOW_STATES = "parquet/window_states"
STABILITY = "parquet/stability"
AUTHOR_KEYS, WINDOW_KEYS = ("author", "genre"), ("author", "genre", "window_size")
# Measures of documents and of windows, and the columns that their means are stored as.
READABILITY = {"flesch_score": "avg_flesch", "km_score": "avg_km", "word_count": "avg_words",
               "sentence_count": "avg_sentences"}
DIALOGUE = {name: f"avg_{name}" for name in ("dialog_ratio", "dialog_lines", "narration_lines")}
SCORES = ("flesch", "km")


def _put(table: DataFrame, path: str, batch: str, *parts: str) -> DataFrame:
    """Write ``table`` as partition ``batch`` of the table at ``path``; read it back."""
    marked = table.withColumn("batch", F.lit(batch))
    marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "batch", *parts
    ).parquet(path)
    stored = table.sparkSession.read.schema(marked.schema).parquet(path)
    return stored.filter(F.col("batch") == batch).drop("batch")


def stored_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """Columns of ``schema`` and ``batch`` of a table in batches; None when there is none."""
    try:
        wanted = StructType([*schema.fields, StructField("batch", StringType())])
        return spark.read.schema(wanted).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def new_books(corpus: DataFrame, folder: str, batch: str, key: str = "title") -> DataFrame:
    """Books whose ``key`` no other batch holds; only that column of the stored ones is read."""
    names = corpus.select(key).schema
    stored = stored_batches(corpus.sparkSession, f"{folder}/{tables.RAW_CORPUS}", names)
    if stored is None:
        return corpus
    others = stored.filter(F.col("batch") != batch).select(key).distinct()
    return corpus.join(others, key, "left_anti").select(*corpus.columns)


def add_books(
    corpus: DataFrame,
    folder: str,
    batch: str,
    configs: Sequence[tuple[int, int]] = DEFAULT_CONFIGS,
    top_n: int = 200,
    key: str = "title",
) -> dict[str, str]:
    """Add the books of ``corpus`` that are not stored yet as ``batch``; the tables' paths.

    Tables of one run of all batches together hold the same rows, but for the column
    ``batch``. Books with a NULL key are always new.
    """
    spark = corpus.sparkSession
    paths = {name: f"{folder}/{place}" for name, place in (
        ("raw_corpus", tables.RAW_CORPUS), ("annotated_corpus", tables.ANNOTATED_CORPUS),
        ("sliding_readability", tables.SLIDING_READABILITY), ("zipf", "parquet/zipf"),
        ("author_states", AUTHOR_STATES), ("window_states", WINDOW_STATES),
    )}
    raw = _put(new_books(corpus, folder, batch, key), paths["raw_corpus"], batch)
    profiled = with_ranked_words(with_windows(annotate(raw), configs), top_n)
    measured = tables.light_corpus(add_segmentation(document_metrics(profiled)))
    stored = _put(measured, paths["annotated_corpus"], batch, "genre")
    windows = _put(expand_windows(stored), paths["sliding_readability"], batch, "window_size")
    _put(expand_ranked_words(stored), paths["zipf"], batch)
    measures = [*READABILITY, *DIALOGUE]
    of_authors, of_windows = (
        states(stored, AUTHOR_KEYS, measures), states(windows, WINDOW_KEYS, SCORES))
    _put(of_authors, paths["author_states"], batch)
    _put(of_windows, paths["window_states"], batch)

    authors = merge(
        stored_batches(spark, paths["author_states"], of_authors.schema), AUTHOR_KEYS, measures)
    paths["stylometry"] = tables.write_author_stats(authors.select(
        *AUTHOR_KEYS, *[mean(m).alias(name) for m, name in READABILITY.items()]), folder)
    paths["segmentation"] = tables.write_dialogue_stats(authors.select(
        *AUTHOR_KEYS, *[mean(m).alias(name) for m, name in DIALOGUE.items()],
        F.col("n_rows").alias("nb_texts")), folder)
    spread = merge(
        stored_batches(spark, paths["window_states"], of_windows.schema), WINDOW_KEYS, SCORES)
    paths["stability"] = f"{folder}/{STABILITY}"
    stability(spread).write.mode("overwrite").parquet(paths["stability"])
    return paths


def stability(merged: DataFrame) -> DataFrame:
    """``windows.window_stability`` from merged states."""
    spread = merged.select(
        *WINDOW_KEYS,
        *[c for s in SCORES for c in (mean(s).alias(f"mean_{s}"), deviation(s).alias(f"std_{s}"))],
    )
    return spread.withColumns({f"cv_{s}": variation(f"std_{s}", f"mean_{s}") for s in SCORES})
