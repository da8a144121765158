"""From links or stored books to a corpus, and its complete analysis."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from textstyle.functions.web import AUTHOR_RULES, stored_name
from textstyle.operators.annotate import annotate
from textstyle.operators.corpus import (
    attribute_author,
    cap_per_author,
    drop_unknown_authors,
    incremental_split,
    number_documents,
    union_corpora,
)
from textstyle.operators.dialogue import add_segmentation, dialogue_stats
from textstyle.operators.lexical import expand_ranked_words, with_ranked_words
from textstyle.operators.readability import author_stats, document_metrics
from textstyle.operators.windows import DEFAULT_CONFIGS, expand_windows, with_windows
from textstyle.sources import files, tables

Rules = Sequence[tuple[str, Sequence[str]]]


def books_to_fetch(
    links: DataFrame, stored: DataFrame, max_books_per_author: int | None = None,
    rules: Rules = AUTHOR_RULES,
) -> DataFrame:
    """Links (``url``) to books of known authors under the cap, if any, with the file name each is
    kept under and whether ``stored`` (``filename``) already holds it."""
    attributed = attribute_author(links.select("url").distinct(), rules=rules)
    if max_books_per_author is not None:
        attributed = cap_per_author(attributed, max_books_per_author)
    capped = drop_unknown_authors(attributed)
    return incremental_split(
        capped.withColumn("filename", stored_name("author", "url")), stored
    ).select("url", "author", "filename", "already_stored")


def corpus_from_folders(
    spark: SparkSession,
    folders: Mapping[str, str],
    max_books_per_author: int | None = None,
    max_chars: int | None = None,
    rules: Rules = AUTHOR_RULES,
    attribute: str = "filename",
) -> DataFrame:
    """One corpus out of a folder of books per genre, ids counted from 0 in each genre."""
    return union_corpora(
        *[
            number_documents(
                files.load_folder(
                    spark, folder, max_books_per_author, max_chars, rules, attribute=attribute
                ),
                genre,
            )
            for genre, folder in folders.items()
        ]
    )


def run_analysis(
    corpus: DataFrame,
    folder: str,
    configs: Sequence[tuple[int, int]] = DEFAULT_CONFIGS,
    top_n: int = 200,
) -> dict[str, str]:
    """Write all six tables and return their paths.

    Texts are tokenised once: the annotated table also keeps each document's windows and
    ranked words as arrays, and all other tables are read from the columns they need of it.
    Nothing is cached, so a lost executor costs its tasks only. The corpora and the words, nearly
    all the bytes of the six tables, are written packed.
    """
    spark = corpus.sparkSession
    paths = {"raw_corpus": tables.write_raw_corpus(corpus, folder, packed=True)}
    raw = tables.read_parquet(spark, paths["raw_corpus"], corpus.schema)

    profiled = with_ranked_words(with_windows(annotate(raw), configs), top_n)
    measured = tables.light_corpus(add_segmentation(document_metrics(profiled)))
    paths["annotated_corpus"] = tables.write_annotated_corpus(measured, folder, packed=True)
    stored = tables.read_parquet(spark, paths["annotated_corpus"], measured.schema)
    paths["stylometry"] = tables.write_author_stats(author_stats(stored), folder)
    paths["segmentation"] = tables.write_dialogue_stats(dialogue_stats(stored), folder)
    paths["sliding_readability"] = tables.write_windows(expand_windows(stored), folder)
    paths["zipf"] = tables.write_zipf(expand_ranked_words(stored), folder, packed=True)
    return paths
