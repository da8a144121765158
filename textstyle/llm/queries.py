"""The registered query of each operator: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from textstyle.llm import (
    language_model,
    line_dedup,
    mixing,
    near_dedup,
    neighbours,
    packing,
    phrases,
    quality,
    suffix_dedup,
    topk,
    toxicity,
    trie,
    url_filter,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op2_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(_table(spark, folder, "embeddings"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), with_ids=False)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    labels = _table(spark, folder, "labels").select("doc_id", "toxic")
    scored = toxicity.score(docs, labels)
    return scored.select("doc_id", "held_out", "score", "predicted",
                         F.size("offending").alias("offending_sentences"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    labels = _table(spark, folder, "labels").select("doc_id", "quality")
    return quality.score(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op6_language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return language_model.score(docs)


def op7_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(_table(spark, folder, "embeddings"))


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict")


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_kept", F.md5(F.col("text").cast("binary")).alias("text_md5")
    )


def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.classify(_table(spark, folder, "documents").select("doc_id", "text"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(_table(spark, folder, "conversations"))


def op12_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    spans = F.transform("removed", lambda span: span["stop"] - span["start"])
    return suffix_dedup.without_repeats(docs).select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.aggregate(spans, F.lit(0).cast("long"), lambda sum_, one: sum_ + one).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.phrases(_table(spark, folder, "documents").select("lang", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_mixing, op2_top_k, op3_packing, op4_toxicity, op5_quality, op6_language_model,
        op7_nearest, op8_url_filter, op9_line_dedup, op10_near_dedup, op11_prefix_trie,
        op12_suffix_dedup, op13_phrases,
    )
} | {"pipeline": corpus_pipeline.run}
