"""Abbreviations learned from a corpus, and sentences that do not end with them.

Unsupervised, after Kiss and Strunk, "Unsupervised Multilingual Sentence Boundary Detection"
(Computational Linguistics 32, 2006): a word that is followed by a full stop more often than
chance allows, and that is short, is an abbreviation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textstyle.functions.text import SENTENCE_END
from textstyle.sources.tables import work_folder

# Fixed values of the method: the chance of a full stop after an abbreviation, and the least
# score of one.
AFTER_ABBREVIATION, LEAST_SCORE = 0.99, 0.3
# So many abbreviations stand in the plan of what is split with them; more are joined to it.
LISTED = 5_000

# A word, full stops inside it included, and those after it.
STOPPED_WORD = r"[\p{L}\p{M}\p{N}]+(?:[.'’\-]+[\p{L}\p{M}\p{N}]+)*\.*"
LAST_WORD = r"([\p{L}\p{M}\p{N}]++(?:[.'’\-]++[\p{L}\p{M}\p{N}]++)*+)\.[ \n\r\t]*+\z"
# Ends a sentence while a text is taken apart; a text that holds it reads a space there.
MARK = "\x01"


def stop_counts(corpus: DataFrame) -> DataFrame:
    """(word, with_stop, without_stop): lower-cased words of all texts, with exactly one full
    stop behind them and otherwise. Words without a letter are left out.

    Occurrences are counted as they are written, each task its own before the shuffle; those
    few rows are then taken apart into word and full stops.
    """
    found = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(STOPPED_WORD), F.lit(0))
    rows = F.transform(found, lambda w: F.struct(F.lower(w).alias("found")))
    counts = corpus.select(F.inline(rows)).groupBy("found").agg(F.count("*").alias("n"))
    word = F.regexp_replace("found", r"\.++\z", "")
    stopped = F.length("found") - F.length(word) == 1
    return (
        counts.select(word.alias("word"), stopped.alias("stopped"), "n")
        .filter(F.col("word").rlike(r"\p{L}"))
        .groupBy("word").agg(
            F.sum(F.when(F.col("stopped"), F.col("n")).otherwise(0)).alias("with_stop"),
            F.sum(F.when(F.col("stopped"), 0).otherwise(F.col("n"))).alias("without_stop"),
        )
    )


def stored_counts(corpus: DataFrame) -> DataFrame:
    """``stop_counts``, written once: the scores read it twice, for its sums and its rows."""
    counts = stop_counts(corpus)
    path = f"{work_folder(corpus.sparkSession)}/stop_counts"
    counts.write.parquet(path)
    return corpus.sparkSession.read.schema(counts.schema).parquet(path)


def abbreviation_scores(counts: DataFrame) -> DataFrame:
    """Add ``score`` to words that are met with a full stop.

    Twice the log-likelihood ratio of "a full stop follows in 99 of 100 cases" to "full stops
    are as frequent after it as after any word", weighed down by the word's length and by its
    occurrences without a full stop, and up by full stops inside it.
    """
    every = F.col("with_stop") + F.col("without_stop")
    # One number.
    overall = counts.agg(F.sum("with_stop") / F.sum(every)).scalar()
    chance = F.col("_chance")

    def log_likelihood(chance: Column) -> Column:
        # No occurrence without a full stop weighs nothing, whatever the chance.
        without = F.when(F.col("without_stop") == 0, 0.0).otherwise(
            F.col("without_stop") * F.log(1 - chance)
        )
        return F.col("with_stop") * F.log(chance) + without

    ratio = -2 * (log_likelihood(chance) - log_likelihood(F.lit(AFTER_ABBREVIATION)))
    letters = F.length(F.replace("word", F.lit("."), F.lit(""))) + 1
    stops = F.length("word") + 2 - letters
    score = ratio * F.exp(-letters) * stops * F.pow(
        letters.cast("double"), -F.col("without_stop").cast("double")
    )
    scored = counts.withColumn("_chance", overall).filter("with_stop > 0")
    return scored.select("word", "with_stop", "without_stop", score.alias("score"))


def abbreviation_words(corpus: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """(word, score): the corpus's abbreviations, lower-cased and without their last full stop."""
    scored = abbreviation_scores(stored_counts(corpus))
    return scored.filter(F.col("score") >= least).select("word", "score")


def learn_abbreviations(
    corpus: DataFrame, least: float = LEAST_SCORE, most: int | None = None
) -> list[str]:
    """The words of ``abbreviation_words``, on the driver; the ``most`` best ones, if that is
    given."""
    best = abbreviation_words(corpus, least)
    if most is not None:
        best = best.orderBy(F.desc("score"), "word").limit(most)
    return sorted(row["word"] for row in best.select("word").collect())


def _parts(text: Column | str) -> Column:
    """A text taken apart behind every end of a sentence; what follows the last one is a part
    too, and has no end."""
    text = F.col(text) if isinstance(text, str) else text
    whole = F.translate(F.coalesce(text, F.lit("")), MARK, " ")
    return F.split(F.regexp_replace(whole, SENTENCE_END, f"$0{MARK}"), MARK)


def _last_word(part: Column) -> Column:
    # No word holds a space, so only what follows the last one is searched.
    end = F.substring_index(F.rtrim(part, F.lit(" \n\r\t")), " ", -1)
    return F.lower(F.regexp_extract(end, LAST_WORD, 1))


def _ended(part: Column, mark: str) -> Column:
    return F.regexp_replace(part, rf"(?:{SENTENCE_END})\z", mark)


def _filled(found: Column) -> Column:
    return F.filter(found, lambda part: F.length(F.trim(part)) > 0)


def sentences_but(text: Column | str, abbreviations: Sequence[str]) -> Column:
    """Sentences of a text as ``functions.text.sentences`` gives them, but that one full stop
    after an abbreviation ends none. NULL text has none.

    The text is marked behind every end of a sentence and taken apart there; parts that end
    with an abbreviation keep their full stop and are put together with the next one.
    """
    def closed(part: Column) -> Column:
        ended = _ended(part, MARK)
        return F.when(_last_word(part).isin(list(abbreviations)), part).otherwise(ended)

    marked = F.transform(
        _parts(text), closed if abbreviations else lambda part: _ended(part, MARK))
    return _filled(F.split(F.array_join(marked, ""), MARK))


def with_sentences(
    texts: DataFrame, abbreviations: DataFrame, folder: str | None = None
) -> DataFrame:
    """Add ``found``: the sentences of ``text`` as ``sentences_but`` gives them, without the
    abbreviations of a table of any length (``word``, all different).

    A table of up to LISTED words is put into the plan. Of a longer one the driver sees no more:
    the texts' parts are written once with a row number to ``folder`` (by default a new one beside
    the session's other tables), their last words are joined to it, and each text gets the places
    of the parts that end no sentence.
    """
    listed = abbreviations.select("word").limit(LISTED + 1).collect()
    if len(listed) <= LISTED:
        return texts.withColumn("found", sentences_but("text", sorted(r["word"] for r in listed)))
    spark = texts.sparkSession
    path = f"{folder or work_folder(spark)}/parts"
    parted = texts.withColumns({
        "_parts": _parts("text"), "_row": F.monotonically_increasing_id()})
    parted.write.parquet(path)
    stored = spark.read.schema(parted.schema).parquet(path)
    last = stored.select("_row", F.inline(F.transform("_parts", lambda part, i: F.struct(
        i.alias("place"), _last_word(part).alias("word")))))
    opened = last.join(abbreviations.select("word"), "word", "left_semi")
    places = opened.groupBy("_row").agg(F.collect_list("place").alias("_open"))
    # What follows the last end of a sentence closes one in any case.
    closing = F.array_except(
        F.sequence(F.lit(0), F.size("_parts") - 1),
        F.coalesce("_open", F.array().cast("array<int>")))
    closed = stored.join(places, "_row", "left").withColumns({
        "_closing": closing, "_ended": F.transform("_parts", lambda part: _ended(part, ""))})

    def sentence(end: Column, k: Column) -> Column:
        before = F.coalesce(F.get("_closing", k - 1), F.lit(-1))
        opening = F.array_join(F.slice("_parts", before + 2, end - before - 1), "")
        return F.concat(opening, F.get("_ended", end))

    return closed.withColumn("found", _filled(F.transform("_closing", sentence))).drop(
        "_parts", "_row", "_open", "_closing", "_ended")
