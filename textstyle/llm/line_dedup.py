"""Lines that resemble an earlier line, found by an exact set-similarity join.

A line is its set of words. It is removed when a line before it, in an earlier document or
higher up in its own, has a Jaccard similarity of ``SIMILAR`` or more. The join:

1. Equal sets become one row with the first place of the set, numbered in the order of places.
2. Tokens are ordered from long to short, those in slots of the hash that a count over the
   corpus found frequent at the end, and each token is taken together with the one that follows
   it in that order. Sets with o common tokens have at least 3 o - m - n - 1 such pairs in
   common, since each token that only one of them has breaks at most three of theirs. Two
   similar sets therefore share one of the first pairs of each: the prefix filter, on pairs that
   hardly ever meet by chance. Any order gives the same result; this one makes few sets meet.
3. Entries of a pair, a set's number, its size and the place in it are shuffled once. Most pairs belong to
   one set only and go there. Each other set is first compared with one earlier set, the one that
   comes first in most of its pairs; a group of near copies is settled so, in proportion to its
   size. Only sets that are still open then meet all earlier ones that share a prefix pair, if
   the length and the positional filter let them pass and a filter on 128 marks of their tokens.
   Two sets meet where a run of their common pairs begins, not again at each pair of the run.
4. Pairs that pass are verified on the words themselves; the later one of a pair goes.

Rows: documents are ordered by doc_id, NULL first, those that share an id (or have none) by the
digest of their text. Lines without words stay. Texts that are NULL or empty stay as they are.
Rows equal in id and text are one document and share their fate. Very long lines are sets like
any other. Columns of the input pass through, those named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textstyle.llm.common import SPACES, fresh, settle

# Similarity as a fraction: 4/5.
OVER, UNDER = 4, 5
# Slots of the tokens' hash that are counted, and those of them that are told from others; a
# documented size of the order's table, not a cut of the data.
SLOTS, FREQUENT = 1 << 16, 2000
# The smallest set that can resemble a different one: four words of five.
SMALLEST = 4
NO_ID = -(2**63)
RESULTS = ("n_lines", "n_kept")
PLACE = ("doc", "tag", "line")
MARKS = ("marks0", "marks1")
# Pairs ahead of one in its prefix that tell whether two sets have met before.
AHEAD = 3


def least_overlap(sizes: Column) -> Column:
    """Common tokens that sets of together ``sizes`` tokens need: ceil(t / (1 + t) sizes)."""
    return F.floor((sizes * OVER + OVER + UNDER - 1) / (OVER + UNDER)).cast("int")


def _tokens(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def frequent_slots(docs: DataFrame, number: int = FREQUENT) -> list[int]:
    """The ``number`` slots of the hash that hold the most words, counted over all words."""
    words_ = docs.select(F.explode(F.split("text", SPACES)).alias("word"))
    slots = words_.groupBy(F.xxhash64("word").bitwiseAND(F.lit(SLOTS - 1)).alias("slot")).count()
    return [row["slot"] for row in slots.orderBy(F.desc("count"), "slot").limit(number).collect()]


# A token stands as a long that sorts long tokens first: one bit for the frequent, six for the
# length, the others from its hash.
HASH_BITS, LONGEST = 56, 63
DEMOTED = 1 << (HASH_BITS + 6)


def _key(token: Column) -> Column:
    length = F.least(F.octet_length(token), F.lit(LONGEST))
    return F.shiftleft((F.lit(LONGEST) - length).cast("long"), HASH_BITS).bitwiseOR(
        F.xxhash64(token).bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    )


def _lines(docs: DataFrame, frequent: list[int]) -> DataFrame:
    """A row per line with words: place, set, number of distinct tokens, prefix, marks.

    The pairs of the prefix are hashed to four bytes: they may meet too often, never less.
    """
    # Told by the text of the line: a filter on its tokens would make them twice.
    line = docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"),
        F.xxhash64("text").alias("tag"),
        F.posexplode(F.split("text", "\n")).alias("line", "content"),
    ).filter(F.col("content").rlike(r"[^\x20\x09-\x0D]"))
    keys = F.array_distinct(F.transform(_tokens(F.col("content")), _key))
    if frequent:
        keys = F.transform(keys, lambda key: F.when(
            key.bitwiseAND(F.lit(SLOTS - 1)).isin(frequent), key.bitwiseOR(F.lit(DEMOTED))
        ).otherwise(key))
    place = F.struct("doc", "tag", "line").alias("place")
    hashed = line.select(place, F.sort_array(keys).alias("tokens")).withColumn("n", F.size("tokens"))
    n = F.col("n")
    # n + 1 less the pairs that the smallest similar set must share.
    smallest = F.floor((n * OVER + UNDER - 1) / UNDER)
    pairs = F.when(n < SMALLEST, 0).otherwise((n + 1 - F.ceil((n + smallest) / 3)).cast("int"))
    counted = hashed.withColumn("pairs", pairs)
    return counted.select(
        "place", F.xxhash64("tokens").alias("set"), "n",
        F.zip_with(
            F.slice("tokens", F.lit(1), F.col("pairs")), F.slice("tokens", F.lit(2), F.col("pairs")),
            lambda token, following: F.hash(token, following),
        ).alias("prefix"),
        *_marks(),
    )


def _marks() -> list[Column]:
    """A set's 128 marks, 64 in each half: whether the number of its tokens with a mark is odd."""
    def turn(seen: Column, token: Column) -> Column:
        place = token.bitwiseAND(F.lit(63)).cast("int")
        return seen.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))

    upper = F.filter("tokens", lambda token: token.bitwiseAND(F.lit(64)) != 0)
    lower = F.filter("tokens", lambda token: token.bitwiseAND(F.lit(64)) == 0)
    return [F.aggregate(half, F.lit(0).cast("long"), turn).alias(name)
            for half, name in zip((lower, upper), MARKS, strict=True)]


def first_places(docs: DataFrame, frequent: list[int]) -> DataFrame:
    """Distinct sets, written with a row number that follows their first places: place, size,
    prefix and marks."""
    firsts = (
        _lines(docs, frequent)
        .groupBy("set")
        .agg(F.min(F.struct("place", "n", "prefix", "marks0", "marks1")).alias("first"))
        .select("first.place.*", "first.n", "first.prefix", "first.marks0", "first.marks1")
        .orderBy(*PLACE)
        .withColumn("row", F.monotonically_increasing_id())
    )
    return settle(firsts, "line-firsts")


def _may_match(a: str, b: str) -> Column:
    """Whether two sets pass the length filter and, at the places of their common pair, the
    positional filter."""
    na, at_a, nb, at_b = (F.col(f"{side}_{c}") for side in (a, b) for c in ("n", "at"))
    need = 3 * least_overlap(na + nb) - na - nb - 1
    left = F.least(na - at_a, nb - at_b) - 1
    return (na * UNDER >= nb * OVER) & (nb * UNDER >= na * OVER) & (left >= need)


def _marks_match(a: str, b: str) -> Column:
    """Whether the marks of two sets let them be similar: tokens in both leave a mark as it is,
    so every mark that differs stands for a token that only one of them has."""
    apart = sum((F.bit_count(F.col(f"{a}_marks{half}").bitwiseXOR(F.col(f"{b}_marks{half}")))
                 for half in (0, 1)), F.lit(0))
    sizes = F.col(f"{a}_n") + F.col(f"{b}_n")
    return apart <= sizes - 2 * least_overlap(sizes)


# Candidate lines are marked in a bitmap of this many bits, a filter of fixed size ahead of
# the join that finds them.
BITS, BUCKET_BITS = 1 << 24, 1 << 15


def _marked(lines: DataFrame, needed: DataFrame) -> DataFrame:
    """The ``lines`` whose place is in ``needed``, and few others."""
    bit = F.pmod(F.xxhash64(*PLACE), F.lit(BITS)) + 1
    bitmaps = needed.select(
        F.bitmap_bucket_number(bit).alias("bucket"), F.bitmap_bit_position(bit).alias("position")
    ).groupBy("bucket").agg(F.bitmap_construct_agg("position").alias("bitmap"))
    position = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.call_function(
        "substring", F.col("bitmap"), (F.floor(position / 8) + 1).cast("int"), F.lit(1)
    )), 16, 10).cast("int")
    hit = F.call_function("shiftright", byte, (position % 8).cast("int")).bitwiseAND(1) == 1
    # At most BITS / BUCKET_BITS rows of 4 KB: 2 MB.
    return (
        lines.withColumn("bucket", F.bitmap_bucket_number(bit))
        .join(F.broadcast(bitmaps), "bucket").filter(hit).select(*lines.columns)
    )


def _verified(pairs: DataFrame, firsts: DataFrame, docs: DataFrame) -> DataFrame:
    """The row numbers b of pairs (a, b), a before b, that are similar in their words."""
    pairs = settle(pairs.distinct(), "line-pairs")
    ends = pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct()
    needed = settle(firsts.select("row", *PLACE).join(ends, "row"), "line-needed")
    lines = docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("tag"),
        F.posexplode(F.split("text", "\n")).alias("line", "content"),
    )
    # Rows equal in id and text are one document.
    contents = (
        _marked(lines, needed).join(needed, list(PLACE)).dropDuplicates(["row"])
        .select("row", F.array_distinct(_tokens(F.col("content"))).alias("tokens"))
        # Words travel as one string, which is much narrower than an array of them.
        .select("row", F.size("tokens").alias("n"), F.array_join("tokens", " ").alias("words"))
    )
    contents = settle(contents, "line-contents")

    def side(name: str) -> DataFrame:
        return contents.select(
            F.col("row").alias(name), F.col("n").alias(f"{name}_n"),
            F.col("words").alias(f"{name}_words"),
        )

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect(F.split("a_words", " "), F.split("b_words", " ")))
    sizes = F.col("a_n") + F.col("b_n")
    return both.filter(common >= least_overlap(sizes)).select(F.col("b").alias("row")).distinct()


def near_lines(firsts: DataFrame, docs: DataFrame) -> DataFrame:
    """(row) of the sets in ``firsts`` that resemble a set with an earlier place."""
    entries = firsts.select("row", "n", F.posexplode("prefix").alias("at", "token"))
    # All sets of a pair, in the order of places.
    group = Window.partitionBy("token").orderBy("row").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    head = [F.first(c).over(group).alias(f"head_{c}") for c in ("row", "n", "at")]
    shared = settle(entries.select(
        "token", "row", "n", "at", *head, F.last("row").over(group).alias("last"),
    ).filter("head_row < last").drop("last"), "line-entries")

    def side(frame: DataFrame, name: str) -> DataFrame:
        return frame.select(
            "token", *[F.col(c).alias(f"{name}_{c}") for c in ("row", "n", "at", "ahead", *MARKS)]
        )

    heads = shared.withColumnsRenamed({"n": "b_n", "at": "b_at"}).filter(
        (F.col("head_row") < F.col("row")) & _may_match("head", "b")
    ).groupBy(F.col("row").alias("b")).agg(F.mode("head_row", deterministic=True).alias("a"))
    settled = settle(_verified(heads.select("a", "b"), firsts, docs), "near-lines")
    at = F.col("at")
    ahead = F.slice("prefix", F.greatest(at - AHEAD, F.lit(0)) + 1, F.least(at, F.lit(AHEAD)))

    def marked(frame: DataFrame) -> DataFrame:
        return frame.join(firsts.select("row", "prefix", *MARKS), "row").withColumn("ahead", ahead)

    a = side(marked(shared), "a")
    b = side(marked(shared.filter("head_row < row").join(settled, "row", "left_anti")), "b")
    met = a.join(b, "token").filter(
        (F.col("a_row") < F.col("b_row")) & _may_match("a", "b") & _marks_match("a", "b")
        # Else they meet at that pair, which stands further ahead in both.
        & ~F.coalesce(F.arrays_overlap("a_ahead", "b_ahead"), F.lit(False))
    ).select(F.col("a_row").alias("a"), F.col("b_row").alias("b"))
    return settled.union(_verified(met, firsts, docs)).distinct()


def dedup_lines(docs: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """Documents without the lines that resemble earlier ones; n_lines, n_kept.

    The text of a document whose lines all go is empty.
    """
    own = docs.drop(*RESULTS)
    firsts = first_places(own, frequent_slots(own, frequent))
    near = near_lines(firsts, own)
    doc, tag, places, parts, signs, left = fresh(
        own, "doc", "tag", "places", "parts", "signs", "left"
    )
    kept = (
        firsts.select("row", *PLACE)
        .join(near, "row", "left_anti")
        .groupBy(F.col("doc").alias(doc), F.col("tag").alias(tag))
        .agg(F.array_sort(F.collect_list("line")).alias(places))
    )
    # One sign per line up to the last kept one, so that each line is looked up in one step.
    gaps = F.transform(places, lambda line, i: F.concat(
        F.repeat(F.lit("0"), line - F.when(i > 0, F.get(places, i - 1)).otherwise(-1) - 1),
        F.lit("1"),
    ))
    lines = F.filter(parts, lambda line, i: (F.get(signs, i) == "1") | ~line.rlike("[^\\x20\\x09-\\x0D]"))
    joined = (
        own.withColumn(doc, F.coalesce("doc_id", F.lit(NO_ID)))
        .withColumn(tag, F.xxhash64("text"))
        .join(kept, [doc, tag], "left")
        .withColumn(parts, F.split("text", "\n"))
        .withColumn(signs, F.split(F.array_join(gaps, ""), ""))
        .withColumn(left, lines)
    )
    columns = [
        F.array_join(left, "\n").alias("text") if c == "text" else F.col(c)
        for c in own.columns
    ]
    count = lambda c: F.when(F.col("text").isNull(), 0).otherwise(F.size(c))
    return joined.select(*columns, count(parts).alias("n_lines"), count(left).alias("n_kept"))
