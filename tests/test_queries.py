"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from textstyle.plans.registry import QUERIES
from check import normal

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in os.listdir(DATA):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{file}'")
    return connection


# What no SQL states; checked below and in test_perceptron.py.
TRAINED = ("perceptron_tags", "tagger_accuracy")


def test_what_has_no_sql():
    assert tuple(name for name in QUERIES if name not in oracle_sql()) == TRAINED


def test_perceptron_beats_the_lexicon_on_held_out_documents(spark):
    rows = {r.tagger: r for r in queries()["tagger_accuracy"](spark, DATA).collect()}
    print(rows)
    assert rows["perceptron"].tokens == rows["lexicon"].tokens > 0
    assert rows["perceptron"].right > rows["lexicon"].right


def test_perceptron_tags_every_token(spark):
    found = {r.id: len(r.pos.split(" ")) for r in
             queries()["perceptron_tags"](spark, DATA).filter("pos <> ''").collect()}
    words = {r.id: len(r.pos.split(" ")) for r in
             queries()["document_tags"](spark, DATA).collect()}
    assert found == words


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in TRAINED])
def test_query(spark, database, name):
    got = normal(queries()[name](spark, DATA).toPandas())
    expected = normal(database.execute(oracle_sql()[name]).df())
    assert list(got.columns) == list(expected.columns)
    assert len(got) > 0
    assert got.map(repr).equals(expected.map(repr))


def test_entry(spark):
    assert entry(spark).columns[:2] == ["author", "genre"]
    assert entry(spark).count() > 0
