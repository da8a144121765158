"""Means and deviations as states that can be stored and merged.

A state of a measure is its number of values, their mean and the sum of their squared
distances from it. Two states merge without the rows behind them (Chan, Golub and LeVeque,
"Updating Formulae and a Pairwise Algorithm for Computing Sample Variances", 1979).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def states(rows: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The keys, ``n_rows``, and a struct (n, mean, m2) under the name of each measure.

    NULL values are not counted; without a value mean and m2 are 0.
    """
    def state(name: str) -> Column:
        n = F.count(name)
        return F.struct(
            n.alias("n"), F.coalesce(F.avg(name), F.lit(0.0)).alias("mean"),
            F.coalesce(F.var_pop(name) * n, F.lit(0.0)).alias("m2"),
        ).alias(name)

    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *map(state, measures))


def _merged(a: Column, b: Column) -> Column:
    n = a["n"] + b["n"]
    gap, share = b["mean"] - a["mean"], b["n"] / F.greatest(n, F.lit(1))
    return F.struct(
        n.alias("n"), (a["mean"] + gap * share).alias("mean"),
        (a["m2"] + b["m2"] + gap * gap * a["n"] * share).alias("m2"),
    )


def merge(stored: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One state per key from any number of them, in the same columns.

    A key has a row per stored batch, so its list is short. It is merged in the order of its
    values: the result does not depend on the order of the rows.
    """
    nothing = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"),
                       F.lit(0.0).alias("m2"))
    lists = stored.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"),
        *[F.sort_array(F.collect_list(name)).alias(name) for name in measures],
    )
    return lists.withColumns({
        name: F.aggregate(name, nothing, _merged) for name in measures
    })


def mean(measure: str) -> Column:
    return F.when(F.col(measure)["n"] > 0, F.col(measure)["mean"])


def deviation(measure: str) -> Column:
    """Sample deviation; NULL for fewer than two values."""
    state = F.col(measure)
    return F.when(state["n"] > 1, F.sqrt(state["m2"] / (state["n"] - 1)))
