import html
import itertools
import random
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from textstyle.functions import web
from textstyle.operators import corpus, harvest
from textstyle.plans.job import books_to_fetch

BASE = "http://h.example:81/a/b.html"
BASES = [BASE, "https://h.example", "https://h.example/", "http://h.example/a/b/c/?x=1#y",
         "http://h.example/x?q=/z/"]
HREFS = ["c.epub", "../c.txt", "/x.TXT", "//o.example/y.epub", "https://z.example/q.epub?d=1",
         "?p=2.txt", "./d/../e.txt#f", "/a/../b/./c.txt", "..", ".", "mailto:x@y", "#top", "",
         "../../../c", "d/./", "d/..", "x?u=../y", "g;x=1/../y"]


@pytest.mark.parametrize("base", BASES)
def test_resolving_agrees_with_urljoin(spark, base):
    pairs = spark.createDataFrame([(base, href) for href in HREFS], "base string, href string")
    rows = pairs.select("href", web.resolve_url("base", "href").alias("url")).collect()
    assert {r.href: r.url for r in rows} == {href: urljoin(base, href) for href in HREFS}


def test_entities(spark):
    texts = ["a &amp; b &eacute;&laquo;&#233;&#xE9;&#128512;&#X1F600; &mdash;", "&nope; & &#; x",
             "&amp;lt;", "no entity", "&#65;&#066;", ""]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r.x for r in frame.select(web.unescape_entities("t").alias("x")).collect()]
    assert found == [html.unescape(t) for t in texts]


def test_html_text(spark):
    page = (
        "<html><style>p{}</style><body><script>if (a<b) x('</p>')</script><!-- <b>no</b> -->"
        "<p>Un <b>mot</b>&nbsp;de\n\n plus</p></body></html>"
    )
    frame = spark.createDataFrame([(page,)], "html string")
    assert frame.select(web.html_to_text("html")).first()[0] == "Un mot de plus"
    assert "\n\n plus" in frame.select(web.html_to_text("html", collapse=False)).first()[0]


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "url string, html string")


def test_page_links(spark):
    page = (
        "<a href='c.EPUB'>1</a><A class=x HREF=\"/t.txt?a=1&amp;b=2\">2</A><a href=x.epub.html>3"
        "</a><a href='page.htm'>4</a><a name='n'>5</a><a href='c.EPUB'>again</a>"
    )
    found = {r.url for r in harvest.page_links(pages(spark, (BASE, page))).collect()}
    assert found == {"http://h.example:81/a/c.EPUB", "http://h.example:81/t.txt?a=1&b=2",
                     "http://h.example:81/a/x.epub.html"}
    assert harvest.page_links(pages(spark, (BASE, page))).count() == 3


def test_raw_file_links(spark):
    page = "<a href='/o/r/blob/m/one.txt'>1</a><a href='/o/r/blob/m/two.txt?x'>2</a>"
    links = harvest.raw_file_links(pages(spark, (BASE, page)), "https://raw.example")
    assert [r.url for r in links.collect()] == ["https://raw.example/o/r/m/one.txt"]


def test_two_hops(spark):
    catalogue = pages(
        spark, (BASE, "<a href='/ebooks/1'>x</a><a href='/ebooks/1'>y</a><a href='/other'>z</a>")
    )
    rows = (
        '<tr><td>Plain\n<i>Text</i> UTF-8</td><td><a class="x" href="/f/1.txt">a</a>'
        ' <a href="/no">b</a></td></tr><tr><td>EPUB</td><td><a href="/f/1.epub">c</a></td></tr>'
        '<tr><td>Plain  Text UTF-8</td><td><a href="/two-spaces">d</a></td></tr>'
        '<tr><td>plain text utf-8</td><td><a name="n">e</a><a href="/second">f</a></td></tr>'
    )
    books = pages(spark, ("http://h.example:81/ebooks/1", rows),
                  ("http://h.example:81/ebooks/2", rows))
    links = harvest.catalogue_links(catalogue, books).collect()
    assert [(r.book_url, r.url) for r in links] == [
        ("http://h.example:81/ebooks/1", "http://h.example:81/f/1.txt")
    ]


def test_rows_as_a_parser_sees_them(spark):
    label = "<td>Plain Text UTF-8</td>"
    page = (
        f"<!-- <tr>{label}<a href='/comment'>x</a></tr> --><script>'<tr>{label}"
        "<a href=\"/script\">x</a></tr>'</script>"
        # An outer row holds the inner one's text and its first link.
        f"<table><tr><td><a href='/outer'>o</a><table><tr>{label}<td><a href='/inner'>i</a></td>"
        "</tr></table></td></tr></table>"
        # Without an end tag a row ends with its table; the next one stands for itself.
        f"<table><tr>{label}<br><a href='/first'>f</a></table><p><a href='/after'>a</a></p>"
        f"<TABLE><TR CLASS='>'>{label}</TR><tr><td><a href='/other'>x</a></td></tr></TABLE>"
        f"</table></tr><tr>{label}<img src=x><a href='/last'>l</a>"
    )
    rows = spark.createDataFrame([(page,), (None,), ("",), ("<tr>",)], "html string").select(
        web.table_rows("html").alias("rows")).collect()
    assert [None if r.rows is None else len(r.rows) for r in rows] == [6, None, None, 1]
    catalogue = pages(spark, (BASE, "<a href='/ebooks/1'>x</a>"))
    books = pages(spark, ("http://h.example:81/ebooks/1", page))
    links = harvest.catalogue_links(catalogue, books).collect()
    assert sorted(r.url.removeprefix("http://h.example:81") for r in links) == [
        "/first", "/inner", "/last", "/outer"]


@pytest.mark.parametrize(
    "url, author",
    [("https://x/sand/dumas.epub", "dumas"), ("https://www.gutenberg.org/1", "balzac"),
     ("thousand.txt", "sand"), ("HUGO.txt", "unknown"), ("ZOLA.txt", "zola")],
)
def test_author_rule(spark, url, author):
    links = spark.createDataFrame([(url,)], "url string")
    assert corpus.attribute_author(links).first().author == author


def test_cap_names_and_unknown(spark):
    urls = [f"https://x/{name}/{i}.txt" for name, i in
            itertools.product(("zola", "sand", "hugo"), range(4))]
    links = corpus.attribute_author(spark.createDataFrame([(u,) for u in urls], "url string"))
    kept = corpus.cap_per_author(links, 2)
    assert sorted(r.url for r in kept.collect()) == sorted(u for u in urls if u[-5] in "01")
    assert corpus.drop_unknown_authors(kept).count() == 4
    named = links.select(web.stored_name("author", "url").alias("n")).first()
    assert named.n == "zola_0.txt"


def test_incremental(spark):
    wanted = spark.createDataFrame([("a",), ("b",), ("c",)], "filename string")
    stored = spark.createDataFrame([("b",), ("b",), ("z",)], "filename string")
    rows = corpus.incremental_split(wanted, stored).collect()
    assert {r.filename: r.already_stored for r in rows} == {"a": False, "b": True, "c": False}
    assert len(rows) == 3
    assert [r.filename for r in corpus.stored_links(wanted, stored).collect()] == ["b"]
    assert corpus.new_links(wanted, stored).count() == 2


def test_numbers_are_dense_and_repeatable(spark):
    rows = [(f"f{i}", f"u{i}", "text", "a") for i in range(500)]
    harvested = spark.createDataFrame(rows, "filename string, url string, text string, author string")
    for digits in (1, 3):
        numbered = corpus.number_documents(harvested, "romantic", digits)
        ids = {r.title: r.id for r in numbered.collect()}
        assert set(ids.values()) == {f"romantic_{i}" for i in range(500)}
        again = corpus.number_documents(harvested.repartition(7), "romantic", digits)
        assert {r.title: r.id for r in again.collect()} == ids
    assert numbered.columns == ["id", "author", "title", "genre", "text"]


def test_truncate_label_union(spark, make_corpus):
    long = corpus.truncate_text(make_corpus("x" * 20), 7)
    both = corpus.union_corpora(
        corpus.label_movement(long, "romantic"), corpus.label_movement(long, "realism")
    )
    assert {(r.genre, r.text) for r in both.collect()} == {("romantic", "x" * 7),
                                                          ("realism", "x" * 7)}
    assert corpus.sorted_authors(both).count() == 1
    with pytest.raises(ValueError):
        corpus.as_corpus(both, id="id")
    assert both.filter(F.length("text") > 7).count() == 0


def test_books_to_fetch(spark):
    urls = [f"https://x/{a}/{i}.txt" for a in ("zola", "hugo") for i in range(4)] * 2
    links = spark.createDataFrame([(u,) for u in urls], "url string")
    stored = spark.createDataFrame([("zola_1.txt",), ("zola_1.txt",)], "filename string")
    rows = books_to_fetch(links, stored, 2).collect()
    assert {(r.filename, r.already_stored) for r in rows} == {("zola_0.txt", False),
                                                             ("zola_1.txt", True)}
    assert len(rows) == 2


def test_rules_from_a_table_equal_the_conditions(spark):
    pick = random.Random(6)

    def word(n):
        return "".join(pick.choice("abc") for _ in range(n))

    rules = [(f"author{i}", tuple(word(pick.randrange(2, 6)) for _ in range(pick.randrange(1, 4))))
             for i in range(60)]
    urls = [(f"https://X/{word(pick.randrange(0, 12)).upper()}.txt",) for _ in range(300)]
    links = spark.createDataFrame([*urls, (None,), ("",)], "url string")
    table = spark.createDataFrame(
        [(i, author, keyword) for i, (author, keywords) in enumerate(rules) for keyword in keywords],
        "place int, author string, keyword string")
    expected = corpus.attribute_author(links, rules=rules).collect()
    found = corpus.attribute_author_by_table(links, table).collect()
    assert found == expected and len({r.author for r in found}) > 5
    # One pass whatever the number of rules.
    many = spark.range(10_000).selectExpr("id + 100 AS place", "'many' AS author", "'no' || id AS keyword")
    assert corpus.attribute_author_by_table(links, table.union(many)).collect() == expected
    none = corpus.attribute_author_by_table(links, table.limit(0)).collect()
    assert {r.author for r in none} == {"unknown"}
    every = spark.createDataFrame([(5, "all", "")], table.schema)
    assert [r.author for r in corpus.attribute_author_by_table(links, every).collect()] == [
        "unknown" if r.url is None else "all" for r in links.collect()]
