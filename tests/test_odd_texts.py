"""Texts and pages made to stall or overflow a matcher, and damaged markup."""

import time

import pytest
from pyspark.sql import functions as F

from textstyle.functions import dialogue, text, web

MANY = 200_000


@pytest.mark.parametrize("name, value, column, expected", [
    ("hyphens", "-".join(["a"] * MANY), lambda c: F.size(text.tokens(c)), 1),
    ("dots", "." * MANY + "x", lambda c: F.size(text.sentences(c)), 1),
    ("quotes", "«" * MANY, lambda c: dialogue.is_dialogue(F.concat(F.lit("x"), c)), False),
    ("scripts", "<script>" * 20_000, lambda c: F.length(web.html_to_text(c)), 0),
    ("comments", "<!-- " * 20_000, lambda c: F.length(web.html_to_text(c)), 0),
    ("rows", "<tr><td>x</td></tr>" * 5_000, lambda c: F.size(web.table_rows(c)), 5_000),
    ("open rows", "<tr>" * 1_000, lambda c: F.size(web.table_rows(c)), 1_000),
    ("cells", "<tr>" + "<td></td>" * 100_000 + "</tr>", lambda c: web.row_text(c), ""),
    ("brackets", "<a " * 20_000, lambda c: F.size(web.hrefs(c)), 0),
])
def test_odd_texts_are_read_once(spark, name, value, column, expected):
    # Not a literal: constant folding would match on the driver.
    frame = spark.createDataFrame([(value,), ("b",)], "t string").repartition(2)
    started = time.time()
    assert expected in [r[0] for r in frame.select(column(F.col("t"))).collect()]
    assert time.time() - started < 20


@pytest.mark.parametrize("markup, expected", [
    ('<a data-href="wrong.epub" href="right.txt">', ["right.txt"]),
    ("<!-- <a href='no.txt'> --><a href='yes.txt'>", ["yes.txt"]),
    ("<script>x = \"<a href='no.txt'>\"</script><a href=yes.txt>", ["yes.txt"]),
    ('<a title="x>y" href="gt.txt">', ["gt.txt"]),
    ('<a href="a&#47;b&eacute;.txt">', ["a/bé.txt"]),
    ('<a title=" href=no" HREF = \'yes\'>', ["yes"]),
    ("<abbr href=no><a>none</a><a/href=yes>", ["yes"]),
    ("", []),
])
def test_links(spark, markup, expected):
    frame = spark.createDataFrame([(markup,)], "m string")
    assert frame.select(web.hrefs("m")).first()[0] == expected


@pytest.mark.parametrize("markup, expected", [
    ("l&apos;homme", "l'homme"), ("if a < b and c > d", "if a < b and c > d"),
    ("<img alt='x>y'>z", "z"), ("a &amp b", "a & b"), ("&#00000233;&#x0000E9;", "éé"),
    ("&NotEqualTilde;&notit;&bogus;&;&", "≂̸¬it;&bogus;&;&"), ("&#0;&#x110000;&#128;", "\ufffd\ufffd€"),
    ("<p>a</p><!-- b --><style>c</style>d<!-- e", "a d"),
])
def test_markup(spark, markup, expected):
    frame = spark.createDataFrame([(markup,)], "m string")
    assert frame.select(web.html_to_text("m")).first()[0] == expected


def test_rows_of_tables(spark):
    frame = spark.createDataFrame([("<tr><td> Plain\n<i>Text</i> UTF-8 </td></tr>",)], "m string")
    assert frame.select(web.row_text("m")).first()[0] == "plain text utf-8"
