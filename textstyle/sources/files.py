"""Stored book files (.txt, .epub) -> harvested rows (filename, url, text, author)."""

from __future__ import annotations

import io
import posixpath
import xml.etree.ElementTree as ElementTree
import zipfile
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textstyle.functions.web import AUTHOR_RULES, html_to_text
from textstyle.operators.corpus import attribute_author, cap_per_author

CONTAINER = "META-INF/container.xml"
# Fixed value: media type of an EPUB's text documents.
DOCUMENT_TYPE = "application/xhtml+xml"


def _file_name(path: Column | str) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Paths and names only: without ``content`` in the plan no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", _file_name("path").alias("filename"))


def _kept_paths(
    spark: SparkSession,
    folder: str,
    max_books: int | None,
    rules: Sequence[tuple[str, Sequence[str]]],
    attribute: str,
) -> DataFrame | None:
    """Paths under the cap, found from names alone; None without a cap."""
    if max_books is None:
        return None
    names = list_files(spark, folder).withColumn("url", F.col("path"))
    listed = attribute_author(names, attribute, rules)
    return cap_per_author(listed, max_books, "filename").select("path")


def _chapters(content: bytes, navigation: bool) -> Iterator[str]:
    """Document items of one EPUB in manifest order, one at a time."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        container = ElementTree.fromstring(book.read(CONTAINER))
        package = next(e.get("full-path") for e in container.iter() if e.tag.endswith("rootfile"))
        folder = posixpath.dirname(package)
        for item in ElementTree.fromstring(book.read(package)).iter():
            if not item.tag.endswith("}item") or item.get("media-type") != DOCUMENT_TYPE:
                continue
            if navigation or "nav" not in (item.get("properties") or "").split():
                name = posixpath.normpath(posixpath.join(folder, unquote(item.get("href"))))
                yield book.read(name).decode("utf-8", "replace")


def _unpacked(books: DataFrame, navigation: bool) -> DataFrame:
    """(path, chapters, error) of each archive, handed on book by book; a damaged book yields
    its error and must not end the job."""
    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                chapters, error = [], None
                try:
                    chapters = list(_chapters(content, navigation)) if content is not None else []
                except Exception as problem:
                    chapters, error = [], f"{type(problem).__name__}: {problem}"
                yield pd.DataFrame({"path": [path], "chapters": [chapters], "error": [error]})

    return books.select("path", "content").mapInPandas(
        unpack, "path string, chapters array<string>, error string"
    )


def _body(markup: Column) -> Column:
    """Inside of the body element; the whole markup when there is none."""
    body = F.regexp_extract(markup, r"(?is)<body\b[^>]*>(.*?)(?:</body\s*>|\z)", 1)
    return F.when(body == "", markup).otherwise(body)


def is_epub() -> Column:
    return F.lower("path").endswith(".epub")


def plain_text(files: DataFrame) -> DataFrame:
    """(path, text, error) of text files: UTF-8 with line ends unified to a line feed, NULL
    when the bytes are not UTF-8."""
    text = F.try_validate_utf8(F.col("content").cast("string"))
    return files.select(
        "path",
        F.regexp_replace(text, "\r\n?", "\n").alias("text"),
        F.when(text.isNull(), "not UTF-8").alias("error"),
    )


def epub_text(files: DataFrame, collapse: bool = False, navigation: bool = True) -> DataFrame:
    """(path, text, error) of EPUB archives.

    Python only unpacks the archive, markup is removed by native expressions; the chapters
    of a book stay in its row, so nothing is shuffled. A damaged archive has an empty text.
    ``navigation=False`` leaves navigation documents out.
    """
    chapters = F.transform("chapters", lambda one: html_to_text(_body(one), collapse))
    return _unpacked(files, navigation).select(
        "path", F.array_join(chapters, "\n").alias("text"), "error"
    )


def epub_chapters(
    files: DataFrame, collapse: bool = False, navigation: bool = True
) -> DataFrame:
    """(path, number, text, error): the chapters of EPUB archives, a row each, from 0 on.

    For books that should not stand in one row: what counts blocks (``add_up_blocks``,
    ``block_windows``, ``zipf_table_of_blocks``) takes chapters as they are, and
    ``joined_chapters`` gives whole texts. A damaged archive, or one without chapters, is one
    row with an empty text, number 0 and its error, if any.
    """
    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                chapters, error = [], None
                try:
                    chapters = list(_chapters(content, navigation)) if content is not None else []
                except Exception as problem:
                    error = f"{type(problem).__name__}: {problem}"
                for number, markup in enumerate(chapters or [""]):
                    yield pd.DataFrame({
                        "path": [path], "number": [number], "markup": [markup], "error": [error]
                    })

    rows = files.select("path", "content").mapInPandas(
        unpack, "path string, number int, markup string, error string"
    )
    return rows.select(
        "path", "number", html_to_text(_body(F.col("markup")), collapse).alias("text"), "error"
    )


def joined_chapters(chapters: DataFrame) -> DataFrame:
    """(path, text, error): the chapters of each book put together, as ``epub_text`` has them."""
    ordered = F.sort_array(F.collect_list(F.struct("number", "text")))
    return chapters.groupBy("path").agg(
        F.array_join(F.transform(ordered, lambda one: one["text"]), "\n").alias("text"),
        F.max("error").alias("error"),
    )


def file_text(files: DataFrame, collapse: bool = False, navigation: bool = True) -> DataFrame:
    """(path, text, error) of binaryFile rows, archives and plain texts each in their way."""
    plain = plain_text(files.filter(~is_epub()))
    return plain.unionByName(epub_text(files.filter(is_epub()), collapse, navigation))


def load_folder(
    spark: SparkSession,
    folder: str,
    max_books_per_author: int | None = None,
    max_chars: int | None = None,
    rules: Sequence[tuple[str, Sequence[str]]] = AUTHOR_RULES,
    keep_unknown: bool = True,
    navigation: bool = True,
    attribute: str = "filename",
) -> DataFrame:
    """Books of a folder: filename, url (the path), text, author, error.

    Authors are named by rules on the file name, or on the whole path with ``attribute="url"``.

    One plan for every size: names are ranked under the cap before any file is opened, and
    the files are joined to the names that are left. Archives are listed by their extension,
    so that no other file is opened for them.
    Files whose text cannot be read keep their place under the cap and are then
    left out; damaged EPUBs stay with an empty text and their error.
    """
    reader = spark.read.format("binaryFile")
    kept = _kept_paths(spark, folder, max_books_per_author, rules, attribute)

    def chosen(files: DataFrame) -> DataFrame:
        return files if kept is None else files.join(kept, "path", "left_semi")

    archives = chosen(reader.option("pathGlobFilter", "*.[eE][pP][uU][bB]").load(folder))
    others = chosen(spark.read.format("binaryFile").load(folder).filter(~is_epub()))
    read = plain_text(others).unionByName(epub_text(archives, navigation=navigation))
    text = F.col("text") if max_chars is None else F.substring("text", 1, max_chars)
    books = read.filter(F.col("text").isNotNull()).select(
        _file_name("path").alias("filename"), F.col("path").alias("url"),
        text.alias("text"), "error",
    )
    books = attribute_author(books, attribute, rules)
    return books if keep_unknown else books.filter(F.col("author") != "unknown")
