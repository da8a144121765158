"""The pipeline's stages, the registered queries against SQL, and their plans."""

import os
import time

import duckdb
import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

import corpus_pipeline
from check import normal
from textstyle.llm import common, line_dedup, mixing, url_filter
from textstyle.llm.oracles import ORACLES
from textstyle.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        assert docs.columns == columns, name
        counts.append(docs.count())
    assert counts[1] < counts[0] and counts[3] <= counts[2] <= counts[1]


def test_pipeline_packs_what_the_stages_leave(spark):
    pieces = corpus_pipeline.run(spark, DATA)
    assert pieces.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                  "sequence_id", "offset"]
    sizes = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert all(r.n == 1024 or r.n & (r.n - 1) == 0 for r in sizes)
    # A document enters as often as it was taken: whole, each time.
    ends = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t"))
    assert ends.filter("n % t <> 0").count() == 0


def test_lines_that_went_leave_empty_documents_out(spark):
    rows = [(1, "a b c\nd e f", "en", "s", 11), (2, "d e f\na b c", "en", "s", 11),
            (3, None, "en", "s", None), (4, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.drop_repeated_lines(spark, docs, DATA).collect()
    assert sorted(r.doc_id for r in left) == [1, 3, 4]


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in os.listdir(DATA):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{file}'")
    return connection


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, database, name):
    got = normal(QUERIES[name](spark, DATA).toPandas())
    expected = normal(database.execute(ORACLES[name]).df())
    assert list(got.columns) == list(expected.columns) and len(got) > 0
    assert got.map(repr).equals(expected.map(repr))


def test_every_operator_has_its_query():
    assert sorted(QUERIES, key=lambda n: (n == "pipeline", len(n.split("_")[0]), n)) == [
        "op1_mixing", "op2_top_k", "op3_packing", "op4_toxicity", "op5_quality",
        "op6_language_model", "op7_nearest", "op8_url_filter", "op9_line_dedup",
        "op10_near_dedup", "op11_prefix_trie", "op12_suffix_dedup", "op13_phrases", "pipeline"]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_native_plans_hold_no_python(spark, monkeypatch):
    """Neither the last frame's plan nor that of any frame written on the way."""
    plans = []

    def spy(frame, name):
        plans.append((name, plan_of(frame)))
        return common.settle(frame, name)

    for module in (mixing, url_filter, line_dedup):
        monkeypatch.setattr(module, "settle", spy)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    for frame in (mixing.mix(docs), url_filter.judge(pages), line_dedup.dedup_lines(docs)):
        plans.append(("result", plan_of(frame)))
    assert {"targets", "url-scores", "line-firsts", "line-pairs"} <= {name for name, _ in plans}
    for name, plan in plans:
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas")), name
        assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan, name


def test_both_sides_of_the_line_join_read_one_shuffle(spark, monkeypatch):
    ran = {}

    def spy(frame, name):
        written = common.settle(frame, name)
        # Run once more: the final plan is known after that.
        again = frame.select("*")
        again.collect()
        ran.setdefault(name, []).append(plan_of(again))
        return written

    monkeypatch.setattr(line_dedup, "settle", spy)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    line_dedup.dedup_lines(docs).count()
    spark.conf.set(threshold, before)
    # The second join of pairs is that of all entries.
    assert len(ran["line-pairs"]) == 2
    assert "ReusedExchange" in ran["line-pairs"][1]


def test_candidate_lines_travel_as_strings(spark, monkeypatch):
    kinds = []

    def spy(frame, name):
        if name == "line-contents":
            kinds.append(dict(frame.dtypes)["words"])
        return common.settle(frame, name)

    monkeypatch.setattr(line_dedup, "settle", spy)
    line_dedup.dedup_lines(spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string"))
    assert kinds == ["string", "string"]


def test_settled_frames_leave_no_shuffle_files(spark):
    """A frame's shuffles are gone once it is written, also in the middle of an operator."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()

    def files():
        return {name for folder in manager.diskBlockManager().localDirsString()
                for _, _, names in os.walk(folder) for name in names if "shuffle_" in name}

    before, setting = files(), spark.conf.get(common.CLEANUP)
    written = common.settle(spark.range(2000).groupBy(F.col("id") % 700).count(), "no-files")
    for _ in range(50):
        # They are removed beside the next query.
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before and written.count() == 700
    with pytest.raises(SparkRuntimeException):
        common.settle(spark.range(1).select(F.raise_error(F.lit("no")).cast("int")), "none")
    assert spark.conf.get(common.CLEANUP) == setting


STAGE_NAMES = [name for name, _ in corpus_pipeline.STAGES]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=STAGE_NAMES)
def test_stages_take_odd_rows_and_no_rows(spark, name, stage):
    """NULLs in every column, empty texts, repeated rows, names that clash; an empty table."""
    text = "one two three four five six seven eight nine"
    rows = [(1, text, "en", "s", 9), (1, text, "en", "s", 9), (None, text + " ten", None, None, None),
            (None, text + " ten", None, None, None), (2, None, "en", "s", 0), (3, "", "en", "s", 0),
            (4, "short", "fr", "t", 5)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = ("parts", "signs", "kept_id", "target_source", "found", "row", "key", "place", "doc", "tag")
    docs = docs.select("*", *[F.lit("mine").alias(c) for c in extra])
    found = stage(spark, docs, DATA)
    none = stage(spark, docs.limit(0), DATA)
    assert none.count() == 0 and stage.__doc__
    if name == "packing":
        assert found.filter("doc_id IS NULL").count() > 0
        return
    assert found.columns == none.columns == docs.columns
    left = found.collect()
    assert all(r[c] == "mine" for r in left for c in extra)
    ids = [r.doc_id for r in left]
    if name == "line_dedup":
        # The first in the order of ids, NULL first, stays, with rows equal to it.
        assert sorted(ids, key=str) == [2, 3, 4, None, None]
    if name == "near_dedup":
        assert sorted(ids, key=str) == [1, 2, 3, 4]


def test_stages_without_lengths(spark):
    docs = spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string")
    assert corpus_pipeline.drop_repeated_lines(spark, docs, DATA).columns == ["doc_id", "text"]
