import random
from pathlib import Path

import pytest
from conftest import plan_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from textstyle.operators import dialogue
from textstyle.operators.dialogue import add_segmentation
from textstyle.operators.lexical import zipf_table
from textstyle.operators.readability import author_stats, document_metrics
from textstyle.operators.windows import readability_windows
from textstyle.plans import chartdata
from textstyle.plans.job import run_analysis
from textstyle.sources import tables


def same(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    right = right.select(left.columns)
    assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_round_trips(spark, make_corpus, tmp_path):
    corpus = make_corpus('Il dit "oui".\nÉté\n— bien, "x"', "un deux " * 700, None, author='a,"b\n')
    folder = str(tmp_path)
    same(corpus, tables.read_parquet(spark, tables.write_raw_corpus(corpus, folder), corpus.schema))
    light = tables.light_corpus(add_segmentation(document_metrics(corpus)))
    assert not {"tokens", "sentences", "seg"} & set(light.columns)
    assert {"dialog_lines", "narration_lines", "dialog_ratio"} <= set(light.columns)
    path = tables.write_annotated_corpus(light, folder)
    same(light, tables.read_parquet(spark, path, light.schema))
    windows = readability_windows(corpus)
    path = tables.write_windows(windows, folder)
    same(windows, tables.read_parquet(spark, path, windows.schema))
    stats = author_stats(light)
    same(stats, tables.read_orc(spark, tables.write_author_stats(stats, folder), stats.schema))
    zipf = zipf_table(corpus)
    same(zipf, tables.read_csv(spark, tables.write_zipf(zipf, folder), zipf.schema))


def test_filters_prune_partitions_and_reach_the_scan(spark, make_corpus, tmp_path):
    windows = readability_windows(make_corpus("un deux " * 700))
    path = tables.write_windows(windows, str(tmp_path))
    kept = tables.read_parquet(
        spark, path, windows.schema, (F.col("window_size") == 500) & (F.col("word_count") > 9)
    )
    plan = plan_of(kept.select("flesch"))
    assert "PartitionFilters: [isnotnull(window_size" in plan
    assert "GreaterThan(word_count,9)" in plan
    assert "ReadSchema: struct<word_count:bigint,flesch:double>" in plan


def test_missing_tables(spark, make_corpus, tmp_path):
    schema = make_corpus("a").schema
    with pytest.raises(AnalysisException):
        tables.read_parquet(spark, str(tmp_path / "none"), schema)
    assert tables.read_csv(spark, str(tmp_path / "none.csv"), schema) is None


def test_sizes(spark, make_corpus, tmp_path):
    tables.write_raw_corpus(make_corpus("un deux"), str(tmp_path))
    (tmp_path / tables.ZIPF).mkdir()
    (tmp_path / tables.ZIPF / "part-0.csv").write_bytes(b"x" * 1_234_567)
    found = {r.table: r.megabytes for r in tables.stored_sizes(spark, str(tmp_path)).collect()}
    assert found[tables.ZIPF] == 1.23 and found[tables.RAW_CORPUS] is not None
    assert found[tables.STYLOMETRY] is None and len(found) == 6
    empty = tables.stored_sizes(spark, str(tmp_path / "nothing"))
    assert {r.megabytes for r in empty.collect()} == {None}


def test_sizes_are_those_of_the_files(spark, make_corpus, tmp_path):
    path = tables.write_raw_corpus(make_corpus("un deux"), str(tmp_path))
    (tmp_path / tables.ZIPF).mkdir()
    (tmp_path / tables.ZIPF / "part-0.csv").write_bytes(b"x" * 1_234)
    found = {r.table: r.bytes for r in tables.stored_sizes(spark, str(tmp_path)).collect()}
    lengths = sum(p.stat().st_size for p in Path(path).rglob("part-*"))
    assert found[tables.RAW_CORPUS] == lengths > 0 and found[tables.ZIPF] == 1_234


def test_work_folder_lies_in_the_shared_one(spark):
    assert tables.work_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert tables.work_folder(spark) != tables.work_folder(spark)


def test_csv_is_read_in_pieces(spark, tmp_path):
    frame = spark.createDataFrame([(i, f"a\nb{i}") for i in range(4000)], "id int, title string")
    path = tables.write_zipf(frame.coalesce(1), str(tmp_path))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        stored = tables.read_csv(spark, path, frame.schema)
        assert stored.rdd.getNumPartitions() > 1
        assert sorted(stored.collect())[7] == (7, "a\nb7") and stored.count() == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_whole_analysis(spark, make_corpus, tmp_path):
    corpus = make_corpus("— un, deux. Trois\nquatre " * 200, "mot " * 600, "")
    paths = run_analysis(corpus, str(tmp_path))
    assert {name for name in paths} == {
        "raw_corpus", "annotated_corpus", "stylometry", "segmentation", "sliding_readability",
        "zipf",
    }
    stored = spark.read.parquet(paths["annotated_corpus"])
    same(
        spark.read.orc(paths["stylometry"]),
        author_stats(stored).select("author", "genre", "avg_flesch", "avg_km", "avg_words",
                                    "avg_sentences"),
    )
    assert spark.read.option("header", True).csv(paths["segmentation"]).first().nb_texts == "3"
    windows = readability_windows(corpus)
    same(windows, tables.read_parquet(spark, paths["sliding_readability"], windows.schema))
    zipf = zipf_table(corpus)
    same(zipf, tables.read_csv(spark, paths["zipf"], zipf.schema))


def test_whole_analysis_takes_little_disk(spark, make_corpus, tmp_path, monkeypatch):
    pick = random.Random(3)
    words = ["".join(pick.choices("abcdefghij", k=pick.randrange(2, 9))) for _ in range(3000)]
    texts = [". ".join(" ".join(pick.choices(words, k=12)) for _ in range(40)) for _ in range(200)]
    corpus = make_corpus(*texts)
    corpus.coalesce(1).write.parquet(f"{tmp_path}/given")
    few = {"compression": "gzip", "maxRecordsPerFile": 5_000}
    monkeypatch.setattr(tables, "PACKED_CSV", few, raising=False)
    paths = run_analysis(spark.read.parquet(f"{tmp_path}/given"), f"{tmp_path}/out")

    def size(path):
        return sum(p.stat().st_size for p in Path(path).rglob("part-*"))

    # Unpacked they took twelve times the given file.
    assert sum(size(path) for path in paths.values()) < 3 * size(f"{tmp_path}/given")
    zipf = zipf_table(corpus)
    same(zipf, tables.read_csv(spark, paths["zipf"], zipf.schema))
    # A packed file is read by one task: there are several.
    assert len([*Path(paths["zipf"]).glob("part-*")]) >= zipf.count() / 5_000 > 2


def test_dialogue_table_falls_back_on_the_corpus(spark, make_corpus, tmp_path):
    folder = str(tmp_path)
    assert chartdata.stored_dialogue(spark, folder) is None
    segmented = dialogue.add_segmentation(make_corpus("- a\nb", "c\nd", "- e"))
    tables.write_annotated_corpus(segmented, folder)
    row = chartdata.stored_dialogue(spark, folder).first()
    assert (row.dialog_lines, row.dialog_ratio) == (2 / 3, 0.5)
    tables.write_dialogue_stats(dialogue.dialogue_stats(segmented), folder)
    assert chartdata.stored_dialogue(spark, folder).first().nb_texts == 3
    bare = str(tmp_path / "bare")
    tables.write_annotated_corpus(make_corpus("a"), bare)
    assert chartdata.stored_dialogue(spark, bare) is None
