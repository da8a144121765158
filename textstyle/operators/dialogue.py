"""Dialogue and narration lines of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textstyle.functions.dialogue import LEADING_MARKS, is_dialogue
from textstyle.functions.text import lines

COUNTS = ["dialog_lines", "narration_lines", "dialog_ratio"]


def _split_lines(texts: DataFrame, leading_marks: str) -> DataFrame:
    """Add ``_lines``, structs of a line and whether it is dialogue: each is tested once."""
    marked = F.transform(
        lines("text"),
        lambda line: F.struct(line.alias("line"), is_dialogue(line, leading_marks).alias("spoken")),
    )
    return texts.withColumn("_lines", marked)


def _spoken(wanted: bool) -> Column:
    return F.filter("_lines", lambda one: one["spoken"] == wanted)


def _joined(marked: Column) -> Column:
    return F.array_join(F.transform(marked, lambda one: one["line"]), "\n")


def dialogue_counts(texts: DataFrame, leading_marks: str = LEADING_MARKS) -> DataFrame:
    """Add dialogue and narration line counts and the share of dialogue."""
    split = _split_lines(texts, leading_marks)
    total, spoken = F.size("_lines"), F.size(_spoken(True))
    return split.withColumns(
        {
            "dialog_lines": spoken,
            "narration_lines": total - spoken,
            "dialog_ratio": spoken / F.greatest(total, F.lit(1)),
        }
    ).drop("_lines")


def add_segmentation(texts: DataFrame, leading_marks: str = LEADING_MARKS) -> DataFrame:
    """Add struct ``seg``: the counts plus the dialogue and the narration text."""
    split = _split_lines(texts, leading_marks)
    total, spoken = F.size("_lines"), F.size(_spoken(True))
    return split.withColumn(
        "seg",
        F.struct(
            spoken.alias("dialog_lines"),
            (total - spoken).alias("narration_lines"),
            (spoken / F.greatest(total, F.lit(1))).alias("dialog_ratio"),
            _joined(_spoken(True)).alias("dialog_text"),
            _joined(_spoken(False)).alias("narration_text"),
        ),
    ).drop("_lines")


def flatten_segmentation(segmented: DataFrame) -> DataFrame:
    """Replace ``seg`` by its three numeric fields; the two texts are dropped."""
    return segmented.withColumns({name: F.col(f"seg.{name}") for name in COUNTS}).drop("seg")


def add_up_blocks(blocks: DataFrame) -> DataFrame:
    """Document counts from texts stored as several rows per id (chapters, turns).

    Counts are summed with partial aggregation; no document is ever put
    together, so one id may own any share of the rows.
    """
    counted = dialogue_counts(blocks)
    summed = counted.groupBy("id", "author", "genre").agg(
        F.sum("dialog_lines").alias("dialog_lines"),
        F.sum("narration_lines").alias("narration_lines"),
    )
    total = F.col("dialog_lines") + F.col("narration_lines")
    return summed.withColumn(
        "dialog_ratio", F.col("dialog_lines") / F.greatest(total, F.lit(1))
    )


def dialogue_stats(counted: DataFrame) -> DataFrame:
    """Mean ratio and line counts and the number of texts by author and genre."""
    flat = flatten_segmentation(counted) if "seg" in counted.columns else counted
    return flat.groupBy("author", "genre").agg(
        F.avg("dialog_ratio").alias("avg_dialog_ratio"),
        F.avg("dialog_lines").alias("avg_dialog_lines"),
        F.avg("narration_lines").alias("avg_narration_lines"),
        F.count(F.lit(1)).alias("nb_texts"),
    )


def column_means(table: DataFrame, containing: str = "dialog") -> DataFrame:
    """Mean of every column whose name contains ``containing``, by author and genre."""
    names = [name for name in table.columns if containing in name]
    return table.groupBy("author", "genre").agg(*[F.avg(name).alias(name) for name in names])
