"""What several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
# Removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPACES = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors reach.

    It is the one named in ``spark.checkpoint.dir``; where that is unset, as in tests,
    a folder in the session's warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return f"{folder.rstrip('/')}/llm"


def settle(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written to the shared folder and read again.

    Cuts the lineage, so that lost executors cost no recomputation of what lies before,
    and gives the planner the true size of small tables. The shuffles behind the written rows
    are not read again; their files go at once, not when the driver collects its garbage.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of at most ``rows`` rows go to Python while a frame is settled: a bound for
    the memory of tasks whose rows are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def words(text: Column) -> Column:
    """The words of a text; none for NULL."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACES)
    return F.filter(parts, lambda part: part != "")


def key_mod(column: str, modulus: int) -> Column:
    """crc32 of a key as text, modulo ``modulus``; a NULL key counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def either(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """Each name, with as many underscores in front as keep it apart from the columns there.

    Spark compares column names without case unless told otherwise.
    """
    taken = {name.lower() for name in frame.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found
