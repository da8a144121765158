"""Mixing sources to target weights.

Words are added up per source; each source's target is its share by weight, held at a
multiple of what it has. The ratio of target and size is the source's repetition rate:
a document is taken floor(rate) times, and once more when a number drawn from the hash of
its id is below the fraction.

Rows: a NULL text has size 0; a NULL source is a source of its own, the last one; a NULL
id is drawn as the empty id. Repeated rows count each, and share their draw. No rows give
no rows. Columns of the input pass through, those named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textstyle.llm.common import WORD, fresh, settle

RESULTS = ("size", "source_size", "target", "rate", "copies", "taken")
# 52 bits of a digest, so that the quotient is exact in a double.
DIGITS = 13


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    text = F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit("")))
    digits = F.substring(F.md5(text.cast("binary")), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("long") / float(16**DIGITS)


def source_targets(
    docs: DataFrame,
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    limit: float = 2.0,
) -> DataFrame:
    """(source, source_size, target, rate), one row per source.

    Sources in the order of their code points, NULL last, take ``weights`` in turn and
    share ``share`` times all words. No target exceeds ``limit`` times its source's size;
    what is cut goes to the other sources by weight. With sources in the order of
    limit / weight this is one running sum: the first source whose level, what is left per
    unit of weight, stays below its own limit sets the level of all that follow.

    The windows run over one row per source, not over documents.
    """
    sizes = docs.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = sizes.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                               (turn % len(weights) + 1).cast("int"))
    ).withColumn("cap", F.col("source_size") * limit)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) * share
        - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / F.sum("weight").over(onwards)
    levels = weighed.select(
        "source", "source_size", "weight", "cap",
        F.row_number().over(by_ratio).alias("place"), level.alias("level"),
    )
    open_from = F.when(F.col("level") * F.col("weight") < F.col("cap"),
                       F.struct("place", "level"))
    return levels.withColumn("first_open", F.min(open_from).over(everything)).select(
        "source",
        "source_size",
        target := F.when(
            F.col("place") >= F.col("first_open.place"),
            F.col("first_open.level") * F.col("weight"),
        ).otherwise(F.col("cap")).alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size"))
        .otherwise(0.0).alias("rate"),
    )


def mix(docs: DataFrame, seed: str = "mix", **settings) -> DataFrame:
    """Every document with its size, its source's size and target, and its copies.

    The targets are written before the join: their true size decides whether the join
    broadcasts them, and a hot source is never grouped or sorted for it.
    """
    own = docs.drop(*RESULTS)
    (of,) = fresh(own, "of")
    targets = settle(source_targets(docs, **settings), "targets").withColumnRenamed("source", of)
    joined = own.join(targets, F.col("source").eqNullSafe(F.col(of)), "left")
    sized = joined.withColumn("size", word_count(F.col("text")))
    whole = F.floor("rate")
    # Documents without an id are told apart by their texts.
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("|"), F.md5(F.col("text").cast("binary"))))
    extra = (draw(key, seed) < F.col("rate") - whole).cast("long")
    return (
        sized.withColumn("copies", whole + extra)
        .withColumn("taken", F.col("size") * F.col("copies"))
        .select(*own.columns, *RESULTS)
    )


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: each document as many times as it is taken, with its own columns."""
    mixed = mix(docs, **settings)
    copy = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    return mixed.select("*", copy).select(*[c for c in docs.columns if c in mixed.columns])
