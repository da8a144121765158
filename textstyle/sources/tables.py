"""Stored tables: layout, writers and readers.

Schemas are passed on reading: partition values and CSV fields would otherwise
be guessed, and guessing reads the data once more.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textstyle.operators.corpus import union_corpora
from textstyle.operators.dialogue import flatten_segmentation

# Where each table lies under the output folder.
RAW_CORPUS = "parquet/raw_corpus"
ANNOTATED_CORPUS = "parquet/annotated_corpus"
SLIDING_READABILITY = "parquet/sliding_readability"
STYLOMETRY = "orc/stylometry"
ZIPF = "zipf.csv"
SEGMENTATION = "segmentation.csv"
TABLES = (RAW_CORPUS, ANNOTATED_CORPUS, SLIDING_READABILITY, STYLOMETRY, ZIPF, SEGMENTATION)

SEGMENTATION_SCHEMA = (
    "author string, genre string, avg_dialog_ratio double, avg_dialog_lines double, "
    "avg_narration_lines double, nb_texts bigint"
)

# The quote is its own escape, as other CSV readers expect; values keep their outer spaces.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# Writers of packed tables. A packed CSV file is read by one task, so it holds few rows; readers
# know it by its ending.
PACKED_PARQUET = {"compression": "zstd"}
PACKED_CSV = {"compression": "gzip", "maxRecordsPerFile": 500_000}

# Columns of annotation that are recomputed on demand and never stored.
HEAVY_COLUMNS = ("document", "sentence", "sentences", "token", "tokens", "pos")


def work_folder(spark: SparkSession) -> str:
    """A new folder for written tables, shared by all executors.

    It lies under ``spark.checkpoint.dir``, or in the session's warehouse, which executors
    share as well, where that is not set.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return f"{shared.rstrip('/')}/textstyle-{uuid.uuid4().hex}"


def write_raw_corpus(corpus: DataFrame, folder: str, packed: bool = False) -> str:
    path = f"{folder}/{RAW_CORPUS}"
    options = PACKED_PARQUET if packed else {}
    corpus.write.mode("overwrite").options(**options).parquet(path)
    return path


def light_corpus(annotated: DataFrame) -> DataFrame:
    """Without annotation arrays; a segmentation struct is kept as plain numbers."""
    light = annotated.drop(*HEAVY_COLUMNS)
    return flatten_segmentation(light) if "seg" in light.columns else light


def write_annotated_corpus(annotated: DataFrame, folder: str, packed: bool = False) -> str:
    path = f"{folder}/{ANNOTATED_CORPUS}"
    writer = light_corpus(annotated).write.mode("overwrite").partitionBy("genre")
    writer.options(**(PACKED_PARQUET if packed else {})).parquet(path)
    return path


def write_windows(windows: DataFrame, folder: str) -> str:
    path = f"{folder}/{SLIDING_READABILITY}"
    windows.write.mode("overwrite").partitionBy("window_size").parquet(path)
    return path


def write_author_stats(stats: DataFrame, folder: str) -> str:
    path = f"{folder}/{STYLOMETRY}"
    stats.write.mode("overwrite").orc(path)
    return path


# What stands for what in the texts of a CSV table.
ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"))


def _map_texts(table: DataFrame, pairs) -> DataFrame:
    def mapped(name: str) -> Column:
        return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, F.col(name))

    return table.select(*[
        mapped(name).alias(name) if kind == "string" else F.col(name) for name, kind in table.dtypes
    ])


def _write_csv(table: DataFrame, path: str, packed: bool = False) -> str:
    """Line breaks in texts are written as ``\\n`` and ``\\r``, so that the files can be read
    in pieces; a backslash is doubled. A packed table's pieces are its files."""
    options = {**CSV_OPTIONS, **(PACKED_CSV if packed else {})}
    _map_texts(table, ESCAPES).write.mode("overwrite").options(**options).csv(path)
    return path


def write_zipf(zipf: DataFrame, folder: str, packed: bool = False) -> str:
    return _write_csv(zipf, f"{folder}/{ZIPF}", packed)


def write_dialogue_stats(stats: DataFrame, folder: str) -> str:
    return _write_csv(stats, f"{folder}/{SEGMENTATION}")


def read_parquet(
    spark: SparkSession, path: str, schema: StructType, where: Column | None = None
) -> DataFrame:
    """Rows of a Parquet table; ``where`` prunes partitions and reaches the scan.

    A missing path is an error, raised by Spark.
    """
    table = spark.read.schema(schema).parquet(path)
    return table if where is None else table.filter(where)


def read_orc(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All parts of an ORC folder."""
    return spark.read.schema(schema).orc(path)


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False
) -> DataFrame | None:
    """A CSV table with header, or None when it was never written.

    Files are split among tasks. ``multi_line`` is for tables of other writers: it reads each
    file whole, with line breaks and backslashes as they are.
    """
    reader = spark.read.schema(schema).options(multiLine=multi_line, **CSV_OPTIONS)
    if not multi_line:
        stored = if_present(lambda: reader.csv(path))
        # The doubled backslash steps aside while the others are read.
        back = [("\\\\", "\0"), ("\\n", "\n"), ("\\r", "\r"), ("\0", "\\")]
        return None if stored is None else _map_texts(stored, back)
    return if_present(lambda: reader.csv(path))


def if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def stored_sizes(spark: SparkSession, folder: str, tables=TABLES) -> DataFrame:
    """Bytes and megabytes of each table, NULL for one that does not exist.

    Sizes come from file listings; no file is opened.
    """
    names = spark.createDataFrame([(name,) for name in tables], "table string")
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    listed = [
        files.select(F.lit(name).alias("table"), "length")
        for name in tables
        if (files := if_present(lambda: listing.load(f"{folder}/{name}"))) is not None
    ]
    if not listed:
        return names.withColumns({
            "bytes": F.lit(None).cast("bigint"), "megabytes": F.lit(None).cast("double")
        })
    sizes = union_corpora(*listed).groupBy("table").agg(
        F.sum("length").alias("bytes"), F.round(F.sum("length") / 1e6, 2).alias("megabytes")
    )
    return names.join(sizes, "table", "left")
