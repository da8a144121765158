"""States of means and deviations, and books added to stored tables batch by batch."""

import random
import statistics

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from textstyle.operators import moments
from textstyle.operators.corpus import union_corpora
from textstyle.operators.dialogue import add_segmentation, dialogue_stats
from textstyle.operators.readability import author_stats, document_metrics
from textstyle.operators.windows import readability_windows, window_stability
from textstyle.plans.updates import add_books, new_books


def test_merged_states_equal_plain_python(spark):
    pick = random.Random(3)
    rows = [(pick.choice(["a", "b", None]), b, None if pick.random() < 0.2 else pick.gauss(1e6, 1))
            for b in range(5) for _ in range(30)]
    rows += [("one", 0, 3.0), ("none", 0, None), ("none", 1, None)]
    table = spark.createDataFrame(rows, "k string, batch int, x double")
    parts = [moments.states(table.filter(F.col("batch") == b), ["k"], ["x"]) for b in range(5)]
    merged = moments.merge(union_corpora(*parts), ["k"], ["x"])
    found = {r.k: r for r in merged.select(
        "k", "n_rows", moments.mean("x").alias("m"), moments.deviation("x").alias("d")).collect()}
    for key in {k for k, _, _ in rows}:
        values = [x for k, _, x in rows if k == key and x is not None]
        assert found[key].n_rows == sum(k == key for k, _, _ in rows)
        assert found[key].m == (pytest.approx(statistics.fmean(values), rel=1e-12) if values else None)
        assert found[key].d == (
            pytest.approx(statistics.stdev(values), rel=1e-9) if len(values) > 1 else None)
    assert moments.merge(parts[0].limit(0), ["k"], ["x"]).count() == 0


@pytest.fixture
def books(spark):
    pick = random.Random(8)
    words = ["le", "maison", "idée", ". ", "— oui.\n", "peut-être"]
    rows = [(f"d{i}", pick.choice(["sand", "zola", None]), f"t{i}", pick.choice(["g", "h"]),
             " ".join(pick.choice(words) for _ in range(pick.randrange(0, 900)))) for i in range(24)]
    rows.append(("d99", "zola", None, "g", None))
    return spark.createDataFrame(
        rows, "id string, author string, title string, genre string, text string")


def rounded(table):
    return [
        tuple(round(v, 6) if isinstance(v, float) else v for v in (r[c] for c in sorted(r.asDict())))
        for r in table.collect()]


def shown(rows):
    return sorted(map(repr, rows))


def test_batches_give_the_tables_of_one_run(spark, books, tmp_path):
    folder = str(tmp_path / "out")
    configs = [(100, 50)]
    first, second = books.filter("id < 'd15'"), books
    add_books(first, folder, "a", configs)
    paths = add_books(second, folder, "b", configs)
    # Again: what a batch has written is replaced, not doubled.
    paths = add_books(second, folder, "b", configs)

    # A book without a title is always new.
    metrics = document_metrics(books)
    stats = author_stats(metrics)
    assert shown(rounded(spark.read.orc(paths["stylometry"]))) == shown(rounded(stats))
    dialogue = dialogue_stats(add_segmentation(books))
    stored = spark.read.option("header", True).schema(dialogue.schema).csv(paths["segmentation"])
    by_name = stored.select(*dialogue.columns)
    assert by_name.count() == dialogue.count()
    windows = readability_windows(books, configs)
    assert shown(rounded(spark.read.parquet(paths["stability"]))) == shown(
        rounded(window_stability(windows)))
    assert spark.read.parquet(paths["raw_corpus"]).count() == books.count()
    assert spark.read.parquet(paths["sliding_readability"]).count() == windows.count()
    batches = spark.read.parquet(paths["annotated_corpus"]).groupBy("batch").count().collect()
    assert sum(r["count"] for r in batches) == books.count() and len(batches) == 2


def test_stored_texts_are_not_opened(books, tmp_path):
    folder = str(tmp_path / "out")
    add_books(books.limit(5), folder, "a", [(100, 50)])
    plan = plan_of(new_books(books, folder, "b"))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("text" not in line.split("ReadSchema")[1] for line in scans)
    assert all("PartitionFilters: [isnotnull(batch" in line for line in scans)


def test_nothing_to_add(spark, books, tmp_path):
    folder = str(tmp_path / "out")
    paths = add_books(books.limit(0), folder, "a", [(100, 50)])
    assert spark.read.schema("author string").orc(paths["stylometry"]).count() == 0
    paths = add_books(books, folder, "b", [(100, 50)])
    assert spark.read.orc(paths["stylometry"]).count() == author_stats(document_metrics(books)).count()
