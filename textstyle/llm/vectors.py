"""Vectors of a table in shards and query blocks, as operators of search read them.

A shard is a bounded number of vectors, so their number grows with the table, and the
queries reach every shard in blocks: a task holds one shard and one block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textstyle.llm.common import arrow_batches, settle


def usable(vector: Column, zeros: bool) -> Column:
    """Not NULL, not empty, all components finite; with ``zeros`` also the zero vector."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < float("inf")))
    fits = vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))
    return fits if zeros else fits & F.exists(vector, lambda x: x != 0)


def numbered(table: DataFrame, zeros: bool) -> DataFrame:
    """(row, vec_id, vector, size) of the rows that take part, written once."""
    vector = F.col("embedding").cast("array<double>")
    rows = table.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"), zeros)).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        vector.alias("vector"), F.size("embedding").alias("size"),
    )
    return settle(rows, "vectors")


def _blocks(rows: DataFrame, per_block: int, pack: Callable[[pd.DataFrame], dict],
            schema: str) -> DataFrame:
    """One row per block of about ``per_block`` vectors of one length."""
    count = rows.count()
    blocks = max(1, ceil(count / per_block))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("vec_id", kind="stable")
        return pd.DataFrame([{
            "size": group["size"].iloc[0], "block": group["block"].iloc[0],
            "ids": group["vec_id"].to_numpy("<i8").tobytes(), **pack(group),
        }])

    return rows.withColumn("block", block).groupBy("size", "block").applyInPandas(
        build, f"size int, block int, ids binary, {schema}"
    )


def matrix(group: pd.DataFrame) -> np.ndarray:
    return np.stack(group["vector"].to_numpy()).astype(np.float64)


def search(rows: DataFrame, every: int, k: int, per_shard: int, per_block: int,
           shard_of: Callable[[pd.DataFrame], dict], schema: str,
           answer: Callable[[dict, np.ndarray, np.ndarray], Iterator[tuple]],
           score_type: str) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of every shard, merged.

    ``shard_of`` prepares a shard, ``answer`` gets a prepared shard, the ids and the vectors
    of a query block, and gives (query_id, vec_id, score) of each query's best in it.
    """
    shards = settle(_blocks(rows, per_shard, shard_of, schema), "shards")
    queries = settle(_blocks(
        rows.filter(F.col("vec_id") % every == 0), per_block,
        lambda group: {"vectors": matrix(group).tobytes()}, "vectors binary",
    ), "query-blocks")
    # The list of shards is small; each block goes to the shards of its vector length.
    meets = shards.groupBy("size").agg(F.collect_list("block").alias("shards"))
    pairs = queries.join(meets, "size").select(
        "size", F.col("ids").alias("query_ids"), "vectors", F.explode("shards").alias("block")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pair in batch.to_dict("records"):
                ids = np.frombuffer(pair["query_ids"], "<i8")
                vectors = np.frombuffer(pair["vectors"]).reshape(len(ids), -1)
                found = list(answer(pair, ids, vectors))
                yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    # A row holds a shard and a query block, so few of them go to Python at a time.
    with arrow_batches(rows.sparkSession, 2):
        found = settle(
            pairs.join(shards, ["size", "block"]).mapInPandas(
                run, f"query_id long, vec_id long, score {score_type}"
            ),
            "search",
        )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
