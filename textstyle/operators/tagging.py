"""Token tags learned from a table of tagged tokens.

A lexicon tagger: the most frequent tag of a word, else of its three-letter
ending, else a default. A word has the same tag everywhere; tags that depend on the
neighbours are the perceptron's (``perceptron.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textstyle.operators.annotate import annotated

ENDING = 3


def _most_frequent_tag(counts: DataFrame, key: str) -> DataFrame:
    """One row per key; equal counts go to the first tag in alphabetical order."""
    best = F.min(F.struct((-F.col("n")).alias("_minus"), F.col("tag")))
    return counts.groupBy(key).agg(best.alias("_best")).select(key, F.col("_best.tag"))


def _lowered() -> Column:
    # Never NULL, so joins add no NULL filter and tokens counted once can be shared.
    return F.lower(F.coalesce("word", F.lit("")))


def _ending(word: str = "word") -> Column:
    return F.substring(word, -ENDING, ENDING)


def train_lexicon(tagged: DataFrame, weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(word -> tag, ending -> tag) from columns ``word`` and ``tag``.

    Tokens are reduced to (word, tag) counts before the first shuffle; endings
    are counted from those, not from the tokens. A table that is already counted
    names its column of counts in ``weight``.
    """
    occurrences = F.lit(1) if weight is None else F.col(weight)
    counts = tagged.groupBy(_lowered().alias("word"), "tag").agg(
        F.sum(occurrences).alias("n")
    )
    by_ending = counts.groupBy(_ending().alias("ending"), "tag").agg(F.sum("n").alias("n"))
    words = _most_frequent_tag(counts, "word").withColumnRenamed("tag", "word_tag")
    endings = _most_frequent_tag(by_ending, "ending").withColumnRenamed("tag", "ending_tag")
    return words, endings


def apply_lexicon(
    tokens: DataFrame, lexicon: DataFrame, endings: DataFrame, default: str = "X"
) -> DataFrame:
    """Add ``tag`` to a table with a ``word`` column.

    Left joins without hints: Spark broadcasts the lexicons when their measured
    size allows it and otherwise splits skewed words at run time.
    """
    return (
        tokens.withColumn("_lowered", _lowered())
        .join(lexicon.withColumnRenamed("word", "_lowered"), "_lowered", "left")
        .withColumn("ending", _ending("_lowered"))
        .join(endings, "ending", "left")
        .withColumn("tag", F.coalesce("word_tag", "ending_tag", F.lit(default)))
        .drop("_lowered", "ending", "word_tag", "ending_tag")
    )


def tag_documents(
    corpus: DataFrame, lexicon: DataFrame, endings: DataFrame, default: str = "X"
) -> DataFrame:
    """(id, pos): one tag per token of a document, in token order; one row per document that
    has tokens.

    Inside its row a document is reduced to its distinct words, each with its places. Only
    these pairs of document and word are joined to the lexicons and gathered again, so that a
    frequent word travels once per document.
    """
    lowered = annotated(corpus).select(
        "id", F.monotonically_increasing_id().alias("_row"),
        F.transform("tokens", lambda t: F.lower(F.coalesce(t, F.lit("")))).alias("_words"),
    )
    # Places sorted by their word's hash: 33 bits of it above 31 of the place, as plain numbers
    # sort much faster than words. Words that share those bits may come in several runs.
    packed = F.sort_array(F.transform("_words", lambda word, i: F.shiftleft(
        F.xxhash64(word), 31).bitwiseOR(i.cast("long"))))
    placed = lowered.withColumn("_at", F.transform(
        packed, lambda p: p.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")))
    last_of_run = F.transform("_at", lambda at, i: F.when(
        ~F.get("_words", at).eqNullSafe(F.get("_words", F.get("_at", i + 1))), i))
    ended = placed.withColumn("_ends", F.filter(last_of_run, lambda i: i.isNotNull()))

    def run(end: Column, k: Column) -> Column:
        before = F.coalesce(F.get("_ends", k - 1), F.lit(-1))
        return F.struct(
            F.get("_words", F.get("_at", end)).alias("word"),
            F.slice("_at", before + 2, end - before).alias("places"),
        )

    words = ended.select("id", "_row", F.inline(F.transform("_ends", run)))
    tagged = apply_lexicon(words, lexicon, endings, default)
    # Two lists in one order. The tags are read for every token, so they are a list of their own
    # and no expression that would be worked out as often.
    gathered = tagged.groupBy("_row", "id").agg(
        F.collect_list("tag").alias("_tags"), F.collect_list("places").alias("_places")
    )
    # Again as plain numbers: the place above the number of its word.
    in_order = F.sort_array(F.flatten(F.transform("_places", lambda places, k: F.transform(
        places, lambda at: F.shiftleft(at.cast("long"), 32).bitwiseOR(k.cast("long"))
    ))))
    return gathered.select("id", F.transform(in_order, lambda one: F.get(
        "_tags", one.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"))).alias("pos"))
