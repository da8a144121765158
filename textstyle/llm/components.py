"""Connected components of a link table, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textstyle.llm.common import settle


def components(links: DataFrame) -> DataFrame:
    """(id, label) for every end of a link (a, b): label is the least id of its component.

    Each round takes the least label among the neighbours, then the label of that label, so
    chains shorten by half; every round is written. Stars, as links to heads give, need few.
    """
    both = settle(
        links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), "links"
    )
    labels = settle(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("id"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = (
            both.join(labels, both["b"] == labels["id"]).groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, labels["id"] == near["a"]).select(
            "id", F.least("label", "near").alias("label"), F.col("label").alias("old")
        )
        lower = settle(lower, "lower-labels")
        jump = lower.select(F.col("id").alias("at"), F.col("label").alias("further"))
        following = settle(
            lower.join(jump, lower["label"] == jump["at"]).select(
                "id", F.least("label", "further").alias("label"),
                (F.least("label", "further") != F.col("old")).alias("changed"),
            ),
            "labels",
        )
        labels = following.select("id", "label")
        if not following.filter("changed").limit(1).count():
            return labels
