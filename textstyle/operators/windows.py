"""Readability along a text, over windows of consecutive tokens.

Every window of a document is computed inside its row from running sums of syllables, so any
number of window sizes costs one scan and no shuffle, and a window costs two lookups.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textstyle.functions.scores import flesch, kandel_moles, variation
from textstyle.functions.syllables import token_syllables
from textstyle.operators.annotate import annotated
from textstyle.operators.scan import ranges, sums_before
from textstyle.sources.tables import work_folder

KEYS = ["id", "author", "genre", "title"]

# Fixed values: (window size, step) in tokens.
DEFAULT_CONFIGS = ((500, 250), (1000, 500))


def _longest(size: int, step: int, mode: str) -> int:
    return size if mode == "sliding" else min(size, step)


def _with_sums(corpus: DataFrame, configs: Sequence[tuple[int, int]], mode: str,
               hyphens: str) -> DataFrame:
    """Add ``_tokens``, their number, and ``_sums``: the syllables before every g-th token,
    then all syllables. All windows begin and end at multiples of g, or at the end.

    Sums of g tokens are added up in chunks of about the root of their number and the chunks
    in turn, because an array that grows by one entry is copied each time.
    """
    grain = math.gcd(*[n for size, step in configs for n in (step, _longest(size, step, mode))])
    zero = F.array(F.lit(0).cast("bigint"))

    def running(values: Column, of) -> Column:
        return F.aggregate(
            values, zero,
            lambda sums, value: F.concat(sums, F.array(F.element_at(sums, -1) + of(value))),
        )

    def starts(total: Column, step: Column) -> Column:
        none = F.array().cast("array<int>")
        return F.when(total > 0, F.sequence(F.lit(0), total - 1, step)).otherwise(none)

    def added(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("bigint"), lambda total, one: total + one)

    width = F.greatest(F.ceil(F.sqrt(F.size("_grains"))), F.lit(1)).cast("int")
    return (
        annotated(corpus).withColumn("_syllables", token_syllables("tokens", hyphens))
        .withColumns({
            "_tokens": F.size("_syllables"),
            "_grains": F.transform(
                starts(F.size("_syllables"), F.lit(grain)),
                lambda start: added(F.slice("_syllables", start + 1, grain)),
            ),
        })
        .withColumn("_chunks", F.transform(
            starts(F.size("_grains"), width),
            lambda start: running(F.slice("_grains", start + 1, width), lambda one: one),
        ))
        .withColumn("_offsets", running(F.col("_chunks"), lambda sums: F.element_at(sums, -1)))
        .withColumn("_sums", F.concat(
            F.flatten(F.transform("_chunks", lambda sums, i: F.transform(
                F.slice(sums, F.lit(1), F.size(sums) - 1),
                lambda sum_: sum_ + F.get("_offsets", i),
            ))),
            F.slice("_offsets", -1, 1),
        ))
        .withColumn("_grain", F.lit(grain))
        .drop("_syllables", "_grains", "_chunks", "_offsets")
    )


def _windows(size: int, step: int, mode: str, min_fill: float) -> Column:
    """Array of (window_index, word_count, syllable_count, window_size, step)."""
    longest = _longest(size, step, mode)
    fewest = max(math.ceil(size * min_fill), 1)
    total = F.col("_tokens")

    def before(place: Column) -> Column:
        return F.get("_sums", F.least((place / F.col("_grain")).cast("int"), F.size("_sums") - 1))

    def window(start: Column) -> Column:
        return F.struct(
            (start / step).cast("int").alias("window_index"),
            F.least(total - start, F.lit(longest)).cast("bigint").alias("word_count"),
            (before(start + longest) - before(start)).alias("syllable_count"),
            F.lit(size).alias("window_size"),
            F.lit(step).alias("step"),
        )

    # A window is kept when it holds `fewest` tokens, which bounds the last start.
    starts = F.when(
        (total >= fewest) & F.lit(fewest <= longest),
        F.sequence(F.lit(0), total - fewest, F.lit(step)),
    ).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, window)


def _check(mode: str) -> None:
    if mode not in ("tumbling", "sliding"):
        raise ValueError(f"mode must be 'tumbling' or 'sliding', not {mode!r}")


def _with_windows(
    corpus: DataFrame, name: str, configs: Sequence[tuple[int, int]], mode: str,
    min_fill: float, hyphens: str, keep_total: bool = False,
) -> DataFrame:
    _check(mode)
    if not configs:
        raise ValueError("no window size is given")
    rows = F.concat(*[_windows(size, step, mode, min_fill) for size, step in configs])
    counted = _with_sums(corpus, configs, mode, hyphens).withColumn(name, rows)
    if keep_total:
        counted = counted.withColumn(f"_syllables_{hyphens}", F.element_at("_sums", -1).cast("int"))
    return counted.drop("_tokens", "_sums", "_grain")


def _scored(measured: DataFrame, words_per_sentence: float) -> DataFrame:
    sentence_count = F.col("word_count") / F.lit(float(words_per_sentence))
    counts = ("word_count", "sentence_count", "syllable_count")
    return measured.withColumn("sentence_count", sentence_count).select(
        *KEYS, "window_index", "word_count", "syllable_count", "sentence_count",
        flesch(*counts).alias("flesch"), kandel_moles(*counts).alias("km"),
        "window_size", "step",
    )


def readability_windows(
    corpus: DataFrame,
    configs: Sequence[tuple[int, int]] = DEFAULT_CONFIGS,
    mode: str = "tumbling",
    min_fill: float = 0.5,
    words_per_sentence: float = 20.0,
    hyphens: str = "count",
) -> DataFrame:
    """One row per document, window configuration and window.

    ``mode="tumbling"``: window k holds the tokens from k*step up to the next
    step. ``mode="sliding"``: window k holds ``size`` tokens from k*step on, so
    windows overlap when step < size. Windows shorter than ``min_fill * size``
    are left out. Sentences are estimated from ``words_per_sentence``.
    """
    measured = _with_windows(corpus, "_windows", configs, mode, min_fill, hyphens)
    # An expression: of a bare column Spark would ask first whether it is empty.
    rows = F.filter("_windows", lambda window: window.isNotNull())
    return _scored(measured.select(*KEYS, F.inline(rows)), words_per_sentence)


def with_windows(
    corpus: DataFrame,
    configs: Sequence[tuple[int, int]] = DEFAULT_CONFIGS,
    mode: str = "tumbling",
    min_fill: float = 0.5,
    hyphens: str = "count",
) -> DataFrame:
    """Add ``windows``: the rows of ``readability_windows`` as an array, without scores; and
    the syllables of the whole text, which ``document_metrics`` then need not count."""
    return _with_windows(corpus, "windows", configs, mode, min_fill, hyphens, keep_total=True)


def expand_windows(profiles: DataFrame, words_per_sentence: float = 20.0) -> DataFrame:
    """``readability_windows`` rows out of stored ``windows``."""
    return _scored(profiles.select(*KEYS, F.inline("windows")), words_per_sentence)


def block_windows(
    blocks: DataFrame,
    order: str,
    configs: Sequence[tuple[int, int]] = DEFAULT_CONFIGS,
    min_fill: float = 0.5,
    words_per_sentence: float = 20.0,
    hyphens: str = "count",
    folder: str | None = None,
) -> DataFrame:
    """Tumbling ``readability_windows`` of documents stored as several rows per id.

    The running sum of the blocks' token counts gives each block its place; a block then
    adds its share to every window it reaches, and the shares are summed. Blocks are measured
    once and written with a row number to ``folder`` (by default a new one beside the
    session's other tables); only counts are ordered, in ranges, so an id may own any share
    of the rows.

    Blocks come in the order of ``order``, NULL first, those with an equal one in the order
    of the table. Blocks without an id are one document.
    """
    folder = folder or work_folder(blocks.sparkSession)
    measured = annotated(blocks).select(
        *KEYS, order, token_syllables("tokens", hyphens).alias("_syllables"),
        F.monotonically_increasing_id().alias("_row"),
    ).withColumn("_size", F.size("_syllables"))
    measured.write.parquet(f"{folder}/blocks")
    measured = blocks.sparkSession.read.schema(measured.schema).parquet(f"{folder}/blocks")
    ranged = ranges(measured.select("id", order, "_row", "_size"), "id", order, "_row", folder)
    places = sums_before(ranged, "id", order, "_row", "_size")

    def shares(size: int, step: int) -> Column:
        first, longest = F.floor(F.col("_place") / step), min(size, step)
        last = F.floor((F.col("_place") + F.col("_size") - 1) / step)

        def share(window: Column) -> Column:
            start = F.greatest(window * step - F.col("_place"), F.lit(0))
            end = F.least(window * step + longest - F.col("_place"), F.col("_size"))
            words = F.greatest(end - start, F.lit(0)).cast("int")
            part = F.slice("_syllables", (start + 1).cast("int"), words)
            return F.struct(
                window.cast("int").alias("window_index"), words.cast("bigint").alias("words"),
                F.aggregate(part, F.lit(0).cast("bigint"), lambda sum_, one: sum_ + one)
                .alias("syllables"),
                F.lit(size).alias("window_size"), F.lit(step).alias("step"),
            )

        reached = F.when(F.col("_size") > 0, F.sequence(first, last)).otherwise(
            F.array().cast("array<bigint>")
        )
        return F.transform(reached, share)

    rows = measured.join(places, "_row").select(
        *KEYS, F.inline(F.concat(*[shares(size, step) for size, step in configs]))
    )
    summed = rows.groupBy(*KEYS, "window_index", "window_size", "step").agg(
        F.sum("words").alias("word_count"), F.sum("syllables").alias("syllable_count")
    )
    filled = summed.filter(F.col("word_count") >= F.ceil(F.col("window_size") * min_fill))
    return _scored(filled, words_per_sentence)


def first_document_windows(
    corpus: DataFrame,
    size: int = 500,
    step: int = 250,
    mode: str = "tumbling",
    min_fill: float = 0.5,
    words_per_sentence: float = 20.0,
    hyphens: str = "count",
) -> DataFrame:
    """Windows of each author's first document (smallest id) that has any.

    One pass over the texts: a document is reduced to its array of windows and
    authors to their first array, partially before the shuffle, so neither texts
    nor the windows of other documents travel.
    """
    reduced = _with_windows(
        corpus, "_windows", [(size, step)], mode, min_fill, hyphens
    ).select(*KEYS, "_windows")
    has_any = F.when(F.size("_windows") > 0, F.col("id"))
    first = reduced.groupBy("author").agg(
        F.min_by(F.struct("id", "genre", "title", "_windows"), has_any).alias("_first")
    )
    rows = first.select(
        "_first.id", "author", "_first.genre", "_first.title",
        F.inline(F.filter("_first._windows", lambda window: window.isNotNull())),
    )
    return _scored(rows, words_per_sentence)


def full_windows(corpus: DataFrame, size: int = 500, step: int = 250) -> DataFrame:
    """Token windows of exactly ``size`` tokens; a shorter text is one window."""
    sliced = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("tokens") - size, F.lit(0)), F.lit(step)),
        lambda start, index: F.struct(
            index.alias("window_index"),
            start.alias("start"),
            F.slice("tokens", start + 1, size).alias("window"),
        ),
    )
    return annotated(corpus).select("id", "author", "genre", "title", F.inline(sliced))


def window_stability(windows: DataFrame) -> DataFrame:
    """Mean, sample deviation and coefficient of variation of both scores."""
    spread = windows.groupBy("author", "genre", "window_size").agg(
        F.avg("flesch").alias("mean_flesch"),
        F.stddev("flesch").alias("std_flesch"),
        F.avg("km").alias("mean_km"),
        F.stddev("km").alias("std_km"),
    )
    return spread.withColumns(
        {
            "cv_flesch": variation("std_flesch", "mean_flesch"),
            "cv_km": variation("std_km", "mean_km"),
        }
    )
