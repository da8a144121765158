"""Physical plans: what must not shuffle, what must be limited before shuffling."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from textstyle.operators import corpus, dialogue, harvest, lexical, windows
from textstyle.plans.registry import QUERIES, book_pages, catalogue_pages
from textstyle.operators.annotate import annotate, exploded_tokens, token_table
from textstyle.operators.readability import document_metrics

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def texts(spark):
    table = spark.read.parquet(f"{DATA}/documents.parquet")
    return corpus.as_corpus(
        table, id="doc_id", author="source", title="source", genre="lang", text="text"
    )


@pytest.mark.parametrize(
    "build",
    [
        document_metrics,
        exploded_tokens,
        token_table,
        windows.readability_windows,
        windows.full_windows,
        lexical.word_frequencies,
        lexical.zipf_table,
        dialogue.add_segmentation,
        dialogue.dialogue_counts,
    ],
)
def test_document_operators_neither_shuffle_nor_leave_the_jvm(texts, build):
    plan = plan_of(build(texts))
    assert "Exchange" not in plan
    assert "Python" not in plan and "Arrow" not in plan
    # One tokenising pass: no filter was pushed down with a copy of it.
    assert plan.count("regexp_extract_all") <= 1
    assert "Filter (" not in plan
    assert "n_chars" not in plan


def test_links_stay_in_the_row_of_their_page(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    plan = plan_of(harvest.page_links(pages))
    assert "Exchange" not in plan and "Filter (" not in plan


def test_caps_and_ranks_are_limited_before_the_shuffle(spark, texts):
    capped = corpus.cap_per_author(texts.select("author", F.col("title").alias("url")), 5)
    ranked = lexical.zipf_table_of_blocks(texts, 20)
    for frame in (capped, ranked):
        plan = plan_of(frame)
        assert "WindowGroupLimit" in plan and "Partial" in plan


def test_numbering_joins_without_moving_texts_twice(texts):
    harvested = texts.select(
        "author", "genre", "text", F.col("title").alias("filename"), F.col("title").alias("url")
    )
    plan = plan_of(corpus.number_documents(harvested, F.col("genre")))
    with_text = [line for line in plan.splitlines() if "ReadSchema" in line and "text:string" in line]
    assert len(with_text) == 1
    assert "SinglePartition" not in plan


def test_annotation_reads_two_columns(texts):
    plan = plan_of(annotate(texts).select("id", F.size("tokens")))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are for tables beyond the broadcast threshold."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize(
    "build", [windows.first_document_windows, lexical.words_of_representatives]
)
def test_representatives_take_one_pass_and_shuffle_reduced_rows(texts, build, no_broadcast):
    plan = plan_of(build(texts))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange") == 1
    assert "Join" not in plan and "partial_min_by" in plan
    assert "Filter (" not in plan


def test_pages_are_reduced_to_links_before_the_join(spark, no_broadcast):
    plan = plan_of(
        harvest.catalogue_links(catalogue_pages(spark, DATA), book_pages(spark, DATA))
    )
    join = plan.index("SortMergeJoin")
    assert "Generate" not in plan[:join]
    assert plan[join:].count("Generate explode") == 2


def test_numbering_orders_no_text(texts, no_broadcast):
    harvested = texts.select(
        "author", "genre", "text", F.col("title").alias("filename"), F.col("title").alias("url")
    )
    plan = plan_of(corpus.number_documents(harvested, F.col("genre")))
    assert sum("text:string" in line for line in plan.splitlines() if "ReadSchema" in line) >= 1
    for line in plan.splitlines():
        assert not ("Window" in line and "text#" in line)


def test_registered_readings_shuffle_only_on_demand(spark):
    before = spark.conf.get("textstyle.partitions", None)
    plan = plan_of(QUERIES["doc_readability"](spark, DATA))
    assert before is None and "Exchange" not in plan
    spark.conf.set("textstyle.partitions", "3")
    try:
        assert plan_of(QUERIES["doc_readability"](spark, DATA)).count("Exchange") == 1
    finally:
        spark.conf.unset("textstyle.partitions")


def test_representatives_of_a_stored_table_do_not_sort_it(spark, no_broadcast):
    stored = spark.range(10).selectExpr("'a' AS author", "id", "id AS frequency")
    plan = plan_of(lexical.representative_documents(stored))
    assert "SortAggregate" not in plan and "partial_max" in plan


def test_the_whole_job_tokenises_once(texts):
    from textstyle.operators.dialogue import add_segmentation

    profiled = lexical.with_ranked_words(windows.with_windows(annotate(texts)), 50)
    plan = plan_of(add_segmentation(document_metrics(profiled)).drop("tokens", "sentences"))
    assert plan.count("regexp_extract_all") == 1 and "Exchange" not in plan


def test_the_whole_job_counts_syllables_once(texts):
    profiled = document_metrics(windows.with_windows(annotate(texts)))
    assert plan_of(profiled).count("[^aeiou") == plan_of(windows.with_windows(annotate(texts))).count("[^aeiou")
    counted = profiled.select("id", "syllable_count").collect()
    assert sorted(counted) == sorted(document_metrics(texts).select("id", "syllable_count").collect())
