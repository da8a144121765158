"""From raw documents to packed sequences: filter, deduplicate, mix, pack.

Every stage takes (spark, docs, sf_dir) and gives a frame that is written and read again as
the next stage's documents; all but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textstyle.llm import line_dedup, mixing, near_dedup, packing, quality
from textstyle.llm.common import settle


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones of them, does not reject.

    NULL and empty texts are scored like others, by the bias alone; rows without an id are
    scored and never learned from; repeated rows share their fate. No rows give no rows.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.score(docs, labels).filter("predicted = 1").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that resemble earlier ones; those left without a line go.

    Documents that had no lines before, without text, stay. The order is that of doc_id, NULL
    first; rows equal in id and text share their fate. A column ``n_chars`` is brought up to
    date. No rows give no rows.
    """
    own = docs.columns
    lines = line_dedup.dedup_lines(docs).filter("n_kept > 0 OR n_lines = 0")
    if "n_chars" in own:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        lines = lines.withColumn("n_chars", length)
    return lines.select(*own)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that with the least id; of rows repeated
    with it, one. NULL ids come last. Texts without words, NULL among them, all stay. No rows
    give no rows.
    """
    return near_dedup.drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as its source's target asks for.

    Texts without words, NULL among them, have no size and are taken by their source's rate
    alike. NULL is a source. Rows without an id are drawn by their text. No rows give no rows.
    """
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens along the curve, with their ids.

    NULL and empty texts are their end mark; every row is packed, repeated ones too. No rows
    give no pieces.
    """
    return packing.pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Trained models, signatures and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
