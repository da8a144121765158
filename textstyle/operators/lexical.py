"""Word frequencies, ranks and mean rank curves."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textstyle.functions.text import STOPWORDS, normalise_word, normalised_words
from textstyle.operators.annotate import annotated

KEYS = ["id", "author", "genre", "title"]


def _sorted_words(corpus: DataFrame, stopwords: Iterable[str]) -> DataFrame:
    """Add ``_words``, the document's words sorted, and ``_ends``, the last index of each run.

    Equal words are adjacent after sorting, so counting them needs no shuffle and
    the text is read once. Each step is its own projection because later ones look
    back into the arrays of earlier ones.
    """
    words = annotated(corpus).withColumn(
        "_words", F.sort_array(normalised_words("tokens", stopwords))
    )
    return words.withColumn("_ends", _run_ends())


def _run_ends() -> Column:
    last_of_run = F.transform(
        "_words", lambda word, i: F.when(~word.eqNullSafe(F.get("_words", i + 1)), i)
    )
    return F.filter(last_of_run, lambda i: i.isNotNull())


def _run_counts() -> Column:
    """Array of (word, frequency): a run is as long as the distance between two ends."""
    return F.transform(
        "_ends",
        lambda end, k: F.struct(
            F.get("_words", end).alias("word"),
            (end - F.coalesce(F.get("_ends", k - 1), F.lit(-1)))
            .cast("bigint")
            .alias("frequency"),
        ),
    )


def token_frequencies(corpus: DataFrame) -> DataFrame:
    """One row per document and token as written, counted inside the row."""
    words = annotated(corpus).withColumn("_words", F.sort_array("tokens"))
    return words.withColumn("_ends", _run_ends()).select(*KEYS, F.inline(_run_counts()))


def word_frequencies(corpus: DataFrame, stopwords: Iterable[str] = STOPWORDS) -> DataFrame:
    """One row per document and word."""
    return _sorted_words(corpus, stopwords).select(*KEYS, F.inline(_run_counts()))


def _with_logs(ranked: DataFrame) -> DataFrame:
    return ranked.withColumns(
        {
            "log_rank": F.log10(F.col("rank").cast("double")),
            "log_freq": F.log10(F.col("frequency").cast("double")),
        }
    )


def zipf_table(
    corpus: DataFrame, top_n: int = 200, stopwords: Iterable[str] = STOPWORDS
) -> DataFrame:
    """Words of each document with frequency, rank and their log10, one row per id.

    Ranks are those of SQL ``rank()``: equal frequencies share one, and all words
    ranked up to ``top_n`` are kept, so ties may give more than ``top_n`` rows.

    Everything happens inside the row. Ids that are spread over several rows, such as
    chapters, are the business of ``zipf_table_of_blocks``.
    """
    limited = _limited_counts(corpus, top_n, stopwords)
    return _with_logs(limited.select(*KEYS, F.inline(_ranked_words())))


def zipf_table_of_blocks(
    blocks: DataFrame, top_n: int = 200, stopwords: Iterable[str] = STOPWORDS
) -> DataFrame:
    """``zipf_table`` of ids that are spread over several rows.

    Counts are added up across rows with a group-by and ranked with a window.
    """
    return _with_logs(_ranked_across_rows(blocks, top_n, stopwords))


def zipf_table_without(
    corpus: DataFrame, stoplist: DataFrame, top_n: int = 200
) -> DataFrame:
    """``zipf_table`` with a stop list of any length: a table with a column ``word``.

    Words are counted inside the rows; the counts are joined to the list, and what is left is
    ranked, a window per document. Entries of the list are normalised like words.
    """
    unwanted = stoplist.select(normalise_word("word").alias("word")).distinct()
    counts = word_frequencies(corpus, ()).join(unwanted, "word", "left_anti")
    by_frequency = Window.partitionBy("id").orderBy(F.desc("frequency"))
    ranked = counts.withColumn("rank", F.rank().over(by_frequency)).filter(F.col("rank") <= top_n)
    return _with_logs(ranked.select(*KEYS, "word", "frequency", "rank"))


def with_ranked_words(
    corpus: DataFrame, top_n: int = 200, stopwords: Iterable[str] = STOPWORDS
) -> DataFrame:
    """Add ``ranked_words``: the rows of ``zipf_table`` as an array, without logs."""
    limited = _limited_counts(corpus, top_n, stopwords)
    return limited.withColumn("ranked_words", _ranked_words()).drop(
        "_words", "_ends", "_counts", "_frequencies", "_least"
    )


def expand_ranked_words(profiles: DataFrame) -> DataFrame:
    """``zipf_table`` rows out of stored ``ranked_words``."""
    return _with_logs(profiles.select(*KEYS, F.inline("ranked_words")))


def _limited_counts(corpus: DataFrame, top_n: int, stopwords: Iterable[str]) -> DataFrame:
    """Add ``_counts`` of the document's words, its ``top_n`` highest frequencies, descending,
    and the least frequency that is still ranked."""
    counted = _sorted_words(corpus, stopwords).withColumn("_counts", _run_counts())
    descending = F.sort_array(F.transform("_counts", lambda e: e["frequency"]), asc=False)
    ordered = counted.withColumn("_frequencies", F.slice(descending, 1, top_n))
    least = F.coalesce(F.get("_frequencies", F.lit(top_n - 1)), F.lit(1))
    return ordered.withColumn("_least", least)


def _ranked_words() -> Column:
    """Array of (word, frequency, rank); a rank is the first place of its frequency."""
    kept = F.filter("_counts", lambda e: e["frequency"] >= F.col("_least"))
    return F.transform(
        kept,
        lambda e: F.struct(
            e["word"].alias("word"),
            e["frequency"].alias("frequency"),
            F.array_position("_frequencies", e["frequency"]).cast("int").alias("rank"),
        ),
    )


def _ranked_across_rows(corpus: DataFrame, top_n: int, stopwords: Iterable[str]) -> DataFrame:
    # Counting inside each row first keeps the shuffle to one entry per row and word.
    partial = word_frequencies(corpus, stopwords)
    total = partial.groupBy(*KEYS, "word").agg(F.sum("frequency").alias("frequency"))
    by_frequency = Window.partitionBy("id").orderBy(F.desc("frequency"))
    ranked = total.withColumn("rank", F.rank().over(by_frequency))
    return ranked.filter(F.col("rank") <= top_n)


def zipf_curve(zipf: DataFrame, by: str = "genre") -> DataFrame:
    """Mean log frequency at each rank, by genre or author."""
    return zipf.groupBy(by, "rank").agg(F.avg("log_freq").alias("log_freq"))


def representative_documents(zipf: DataFrame) -> DataFrame:
    """Per author, the document holding the author's most frequent word.

    Ties go to the smallest id. The highest frequency per author is a hash
    aggregation with partial results; only rows that reach it are left to rank.
    """
    most = zipf.groupBy("author").agg(F.max("frequency").alias("frequency"))
    reached = zipf.select("author", "frequency", "id").join(most, ["author", "frequency"])
    return reached.groupBy("author").agg(F.min("id").alias("id"))


def representative_words(zipf: DataFrame, head: int = 50) -> DataFrame:
    """The ``head`` most frequent words of each author, one document per author given."""
    order = Window.partitionBy("author").orderBy(F.desc("frequency"), "word")
    return (
        zipf.withColumn("_position", F.row_number().over(order))
        .filter(F.col("_position") <= head)
        .drop("_position")
    )


def words_of_representatives(
    corpus: DataFrame, head: int = 50, stopwords: Iterable[str] = STOPWORDS
) -> DataFrame:
    """``representative_words`` straight from a corpus, in one pass over the texts.

    A document is reduced to its ``head`` words and authors to their best
    document, partially before the shuffle.
    """
    limited = _limited_counts(corpus, head, stopwords)
    by_frequency = F.transform(
        _ranked_words(),
        lambda e: F.struct(
            (-e["frequency"]).alias("_minus"), e["word"].alias("word"),
            e["frequency"].alias("frequency"), e["rank"].alias("rank"),
        ),
    )
    reduced = limited.select(
        *KEYS, F.slice(F.sort_array(by_frequency), 1, head).alias("_head"),
        (-F.get("_frequencies", F.lit(0))).alias("_minus"),
    )
    order = F.when(F.col("_minus").isNotNull(), F.struct("_minus", "id"))
    best = reduced.groupBy("author").agg(
        F.min_by(F.struct("id", "genre", "title", "_head"), order).alias("_best")
    )
    rows = F.transform("_best._head", lambda e: F.struct(e["word"], e["frequency"], e["rank"]))
    return _with_logs(
        best.select("_best.id", "author", "_best.genre", "_best.title", F.inline(rows))
    )
