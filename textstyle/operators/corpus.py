"""Corpus building: one row per document with id, author, title, genre and text."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textstyle.functions.text import _col
from textstyle.functions.web import AUTHOR_RULES, UNKNOWN_AUTHOR, author_of

CORPUS_COLUMNS = ["id", "author", "title", "genre", "text"]

# Hexadecimal digits of the name hash that number documents group by group.
NUMBERING_DIGITS = 3


def as_corpus(table: DataFrame, **columns: Column | str) -> DataFrame:
    """Map any table of texts to the corpus columns, e.g. ``id="doc_id"``."""
    missing = set(CORPUS_COLUMNS) - set(columns)
    if missing:
        raise ValueError(f"no source given for {sorted(missing)}")
    return table.select(*[_col(columns[name]).alias(name) for name in CORPUS_COLUMNS])


def number_documents(
    harvested: DataFrame, genre: str | Column, digits: int = NUMBERING_DIGITS
) -> DataFrame:
    """Corpus from harvested files, with id ``<genre>_<i>`` counted from 0 per genre.

    Numbers are dense and repeatable: files are ordered by the first ``digits``
    hexadecimal digits of the MD5 of their url, then by url. The digits cut each
    genre into ``16 ** digits`` groups that are numbered in parallel, and a table
    of at most that many counts per genre supplies each group's first number, so
    no task ever sorts a whole genre. Only urls and hashes are numbered; texts are joined to
    their numbers afterwards. A NULL genre counts as the empty one, a NULL url as the empty
    url. Rows that share a url are told apart by author and file name; rows equal in all three
    are one file and share its id.
    """
    genre = F.lit(genre) if isinstance(genre, str) else genre
    rows = harvested.select(
        "author", F.col("filename").alias("title"), genre.alias("genre"), "text",
        F.coalesce(genre, F.lit("")).alias("_genre"), F.coalesce("url", F.lit("")).alias("_url"),
        F.xxhash64("author", "filename").alias("_hash"),
    )
    files = rows.select("_genre", "_url", "_hash").distinct().withColumn(
        "_group", F.substring(F.md5("_url"), 1, digits)
    )
    sizes = files.groupBy("_genre", "_group").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy("_genre").orderBy("_group").rowsBetween(
        Window.unboundedPreceding, -1
    )
    firsts = sizes.select(
        "_genre", "_group", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_first")
    )
    within = Window.partitionBy("_genre", "_group").orderBy("_url", "_hash")
    numbers = (
        files.withColumn("_inside", F.row_number().over(within))
        .join(firsts, ["_genre", "_group"])
        .select("_genre", "_url", "_hash", (F.col("_first") + F.col("_inside") - 1).alias("_number"))
    )
    return rows.join(numbers, ["_genre", "_url", "_hash"]).select(
        F.concat("_genre", F.lit("_"), F.col("_number").cast("string")).alias("id"),
        "author", "title", "genre", "text",
    )


def union_corpora(*corpora: DataFrame) -> DataFrame:
    """One corpus out of several, columns matched by name."""
    return reduce(DataFrame.unionByName, corpora)


def truncate_text(corpus: DataFrame, max_chars: int) -> DataFrame:
    """Keep the first ``max_chars`` characters of each text."""
    return corpus.withColumn("text", F.substring("text", 1, max_chars))


def attribute_author(
    links: DataFrame,
    url: str = "url",
    rules: Sequence[tuple[str, Sequence[str]]] = AUTHOR_RULES,
) -> DataFrame:
    return links.withColumn("author", author_of(url, rules))


# Rules that tasks hold as one automaton.
MOST_RULES = 1_000_000


def attribute_author_by_table(links: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``attribute_author`` with rules from a table (place, author, keyword), however many.

    The rule with the least place one of whose keywords is in the lower-cased url names the
    author; keywords are compared in lower case. All keywords are sought in one pass over a
    url, by an automaton that every task builds from the same bounded list.
    """
    listed = rules.select(
        F.col("place").cast("long").alias("place"), "author",
        F.lower(F.coalesce("keyword", F.lit(""))).alias("keyword"),
    ).groupBy("keyword").agg(F.min(F.struct("place", "author")).alias("rule"))
    found = listed.limit(MOST_RULES + 1).collect()
    if len(found) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} keywords")
    always = min((tuple(r["rule"]) for r in found if r["keyword"] == ""), default=None)
    keywords = [(r["keyword"], *r["rule"]) for r in found if r["keyword"]]
    shared = links.sparkSession.sparkContext.broadcast(keywords)

    @F.pandas_udf("string")
    def author(urls: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for keyword, *rule in shared.value:
            automaton.add_word(keyword, tuple(rule))
        automaton.make_automaton()
        fallback = [always] if always else []

        def first(value: str | None) -> str:
            hits = automaton.iter(value.lower()) if value and len(automaton) else ()
            best = min([*(rule for _, rule in hits), *(fallback if value is not None else [])],
                       default=None)
            return best[1] if best else UNKNOWN_AUTHOR

        for batch in urls:
            yield batch.map(first, na_action=None)

    return links.withColumn("author", author(url))


def drop_unknown_authors(links: DataFrame) -> DataFrame:
    return links.filter(F.col("author") != UNKNOWN_AUTHOR)


def cap_per_author(links: DataFrame, max_books: int, order: str | Column = "url") -> DataFrame:
    """First ``max_books`` rows of each author.

    Spark limits each input partition before the shuffle, so a dominant author
    sends at most ``max_books`` rows per task.
    """
    position = F.row_number().over(Window.partitionBy("author").orderBy(order))
    return (
        links.withColumn("_position", position)
        .filter(F.col("_position") <= max_books)
        .drop("_position")
    )


def label_movement(links: DataFrame, genre: str) -> DataFrame:
    return links.withColumn("genre", F.lit(genre))


def stored_links(candidates: DataFrame, stored: DataFrame, key: str = "filename") -> DataFrame:
    """Candidates whose file is already stored."""
    return candidates.join(stored.select(key), key, "left_semi")


def new_links(candidates: DataFrame, stored: DataFrame, key: str = "filename") -> DataFrame:
    """Candidates still to be fetched."""
    return candidates.join(stored.select(key), key, "left_anti")


def incremental_split(
    candidates: DataFrame, stored: DataFrame, key: str = "filename"
) -> DataFrame:
    """All candidates, flagged ``already_stored``, in one pass over them."""
    names = stored.select(key).distinct().withColumn("_found", F.lit(True))
    return (
        candidates.join(names, key, "left")
        .withColumn("already_stored", F.coalesce("_found", F.lit(False)))
        .drop("_found")
    )


def only_documents(table: DataFrame, documents: DataFrame) -> DataFrame:
    """Rows of the listed documents (``author``, ``id``)."""
    return table.join(documents, ["author", "id"], "left_semi")


def summary_columns(table: DataFrame, names: Mapping[str, str], digits: int = 2) -> DataFrame:
    """Rename columns for display and round the floating-point ones, halves to even."""
    scale = float(10**digits)
    rounded = [
        (F.rint(F.col(name) * scale) / scale).alias(name)
        if kind in ("double", "float")
        else F.col(name)
        for name, kind in table.dtypes
    ]
    return table.select(*rounded).withColumnsRenamed(dict(names))


def sorted_authors(corpus: DataFrame) -> DataFrame:
    return corpus.select("author").distinct().orderBy("author")
