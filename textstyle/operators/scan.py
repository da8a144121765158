"""Running sums along documents that are stored as many rows.

A sum over a window of one id would sort all rows of the id in one task. Here rows are
range-partitioned by id and order, so an id may fill many ranges; each range adds up its own
rows, the sums of an id's ranges are added up in a small window, and both together give every
row what lies before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranges(rows: DataFrame, key: str, order: str, row: str, folder: str) -> DataFrame:
    """``rows`` with ``_part``, the number of the range they lie in; written to ``folder``,
    since a second run might draw other borders.

    ``row`` tells rows of equal key and order apart, so these may fill several ranges too.
    """
    path = f"{folder}/ranges"
    dealt = rows.repartitionByRange(key, order, row).withColumn("_part", F.spark_partition_id())
    dealt.write.parquet(path)
    return rows.sparkSession.read.schema(dealt.schema).parquet(path)


def sums_before(ranged: DataFrame, key: str, order: str, row: str, size: str) -> DataFrame:
    """(row, _place): the sum of ``size`` over the rows of the same key before each row.

    Rows are in the order of ``order``, NULL first, then of ``row``. NULL is a key as well.
    """
    inside = Window.partitionBy(key, "_part").orderBy(order, row).rowsBetween(
        Window.unboundedPreceding, -1
    )
    # One row for each key and range.
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(key, "_part").agg(F.sum(size).alias("_total"))
    before = totals.select(
        F.col(key).alias("_key"), F.col("_part").alias("_of"),
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"),
    )
    here = ranged.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    same = here[key].eqNullSafe(before["_key"]) & (here["_part"] == before["_of"])
    return here.join(before, same).select(
        row, (F.col("_before") + F.col("_inside")).alias("_place")
    )
