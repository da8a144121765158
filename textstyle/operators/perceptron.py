"""Token tags that depend on the neighbours: an averaged perceptron.

A token's tag is the one with the highest sum of weights of its features: the word, its ending,
whether it is capitalised, its neighbours and their endings, and the tags given to the tokens
before it in the sentence. Weights lie in one table of fixed size, addressed by hashes of the
features, so a model is one array whatever the vocabulary.

Training goes over all tagged texts: a token whose tag is guessed wrong moves the weights of its
features by one from the guess to the tag, and the weights are averaged over all steps. Texts are
dealt to shards, a task each; every epoch begins on all shards with the same weights, and ends
with the mean of theirs (iterative parameter mixing: McDonald, Hall and Mann, "Distributed
Training Strategies for the Structured Perceptron", 2010). Within a shard many sentences are
learned from side by side, in steps of one token each. Sums that are shuffled are of whole
numbers, so a model does not depend on how rows are stored or added up. A bounded sample, if one
is asked for, is learned from token by token in one task.

Tagging is one Arrow pass without a shuffle: scores that do not depend
on tags are summed for all tokens at once, then all sentences of a block are decoded side by
side, token by token, always taking the best tag (the first of equal ones).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textstyle.sources.tables import work_folder

ENDING = 3
# How often texts are learned from; rows of a bounded sample, and tokens of each.
EPOCHS = 5
ROWS, PER_ROW = 300, 200
# Tokens of a shard, and sentences at most that are learned from side by side: one for so many
# tokens of a block.
SHARD, LANES, PER_LANE = 4_000_000, 128, 1_000
# Features share this many rows of weights: 2 ** BITS.
BITS = 18
# A run of tokens without the end of a sentence is decoded in parts of this length.
LONGEST = 500
# Tokens that are scored together.
BLOCK = 100_000
SENTENCE_END = (".", "!", "?", "…")

# Kinds of features. The first ones are known before any tag is.
FIXED_KINDS, TAG_KINDS = 9, 3
CAPITAL, LAST = 1, 2


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_KIND = mix(np.arange(1, FIXED_KINDS + TAG_KINDS + 1, dtype=np.uint64))


def _place(kind: int, value: np.ndarray, bits: int) -> np.ndarray:
    return (mix(value ^ _KIND[kind]) >> np.uint64(64 - bits)).astype(np.int64)


def _token_columns(tokens: str) -> list[Column]:
    """Digests of words and endings, and marks, of a token array."""
    lowered = F.transform(tokens, lambda t: F.lower(t))
    return [
        F.transform(lowered, lambda t: F.xxhash64(t)).alias("_words"),
        F.transform(lowered, lambda t: F.xxhash64(F.substring(t, -ENDING, ENDING))).alias("_endings"),
        F.transform(
            tokens,
            lambda t: F.when(t.isin(*SENTENCE_END), LAST)
            .when(F.lower(t) != t, CAPITAL).otherwise(0),
        ).alias("_marks"),
    ]


def sentence_starts(marks: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where sentences start: with each row, after end marks, and after LONGEST tokens."""
    new = np.zeros(len(marks), dtype=bool)
    new[starts[starts < len(marks)]] = True
    last = marks == LAST
    new[1:] |= last[:-1] & ~last[1:]
    begin = np.maximum.accumulate(np.where(new, np.arange(len(marks)), 0))
    new |= (np.arange(len(marks)) - begin) % LONGEST == 0
    return np.flatnonzero(new)


def fixed_features(words: np.ndarray, endings: np.ndarray, marks: np.ndarray,
                   starts: np.ndarray, bits: int) -> np.ndarray:
    """(token, kind) -> row of weights, of the features that need no tags.

    Beyond a sentence's borders a neighbour is 0.
    """
    words, endings = words.view(np.uint64), endings.view(np.uint64)
    first = np.zeros(len(words), dtype=bool)
    first[starts] = True
    last = np.r_[first[1:], True]

    def shifted(values: np.ndarray, border: np.ndarray, by: int) -> np.ndarray:
        return np.where(border, np.uint64(0), np.roll(values, by))

    capital = (marks == CAPITAL).astype(np.uint64)
    values = (
        np.zeros(len(words), np.uint64), words, endings, capital + np.uint64(2) * first,
        shifted(words, first, 1), shifted(words, last, -1),
        shifted(endings, first, 1), shifted(endings, last, -1), mix(endings) ^ capital,
    )
    return np.stack([_place(k, v, bits) for k, v in enumerate(values)], axis=1)


def tag_features(words: np.ndarray, before: np.ndarray, last: np.ndarray, bits: int) -> np.ndarray:
    """The rows of weights of the features with the one and two tags before a token."""
    last, before = (x.astype(np.uint64) + np.uint64(1) for x in (last, before))
    values = np.broadcast_arrays(
        last, last * np.uint64(1 << 20) + before, mix(words.view(np.uint64)) ^ last
    )
    return np.stack([_place(FIXED_KINDS + k, v, bits) for k, v in enumerate(values)], axis=-1)


@dataclass(frozen=True)
class Tagger:
    """Tags and the weights of all features for each of them."""

    tags: list[str]
    weights: np.ndarray

    @property
    def bits(self) -> int:
        return int(len(self.weights)).bit_length() - 1


def learn(sentences: list[tuple], tags: list[str], epochs: int, bits: int) -> np.ndarray:
    """Averaged weights from (words, fixed features, tag numbers) of each sentence."""
    weights = np.zeros((1 << bits, len(tags)), dtype=np.float64)
    moved = np.zeros_like(weights)
    step, nothing = 0, len(tags)
    # Features with tags, for all tags that may stand before a token.
    every = np.arange(nothing + 1)
    of_tags = tag_features(np.zeros(1, np.int64), every[None], every[:, None], bits)[..., :-1]
    of_words = [tag_features(words[:, None], every[:1], every, bits)[..., -1:]
                for words, _, _ in sentences]
    order = np.random.default_rng(1)
    for _ in range(epochs):
        for number in order.permutation(len(sentences)).tolist():
            _, fixed, gold = sentences[number]
            with_word = of_words[number]
            before, last = nothing, nothing
            for i, right in enumerate(gold.tolist()):
                step += 1
                rows = np.concatenate((fixed[i], of_tags[last, before], with_word[i, last]))
                guess = int(weights[rows].sum(axis=0).argmax())
                if guess != right:
                    for table, by in ((weights, 1), (moved, step)):
                        np.add.at(table, (rows, right), by)
                        np.add.at(table, (rows, guess), -by)
                before, last = last, guess
    return (weights - moved / max(step, 1)).astype(np.float32)


def learn_side_by_side(
    weights: np.ndarray, moved: np.ndarray, step: int, by: int, block: tuple, bits: int,
    order: np.random.Generator,
) -> int:
    """One pass over a block's (words, fixed features, tag numbers, starts of sentences).

    The block's sentences, in random order, are cut into lanes of about equal length. Each step
    guesses a token of every lane with the same weights, then moves them by ``by`` for each wrong
    guess; ``moved`` adds up moves of one times the tokens met until then. Returns these.
    """
    words, fixed, gold, starts = block
    size, nothing = len(words), weights.shape[1]
    lengths = np.diff(np.r_[starts, size])
    drawn = order.permutation(len(starts))
    begins = np.cumsum(lengths[drawn]) - lengths[drawn]
    at = np.repeat(starts[drawn] - begins, lengths[drawn]) + np.arange(size)
    new = np.zeros(size, dtype=bool)
    new[begins] = True
    lane = begins * min(max(size // PER_LANE, 1), LANES) // size
    lanes = begins[np.r_[True, lane[1:] > lane[:-1]]]
    sizes = np.diff(np.r_[lanes, size])
    longest_first = np.argsort(-sizes, kind="stable")
    lanes, sizes = lanes[longest_first], sizes[longest_first]
    # Tokens in the order of the steps, so that each step reads what lies together.
    steps = np.arange(size) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    by_step = (np.repeat(lanes, sizes) + steps)[np.argsort(steps, kind="stable")]
    at, new = at[by_step], new[by_step]
    fixed, gold, hashed = fixed[at], gold[at], mix(words[at].view(np.uint64))
    every = np.arange(nothing + 1)
    of_tags = tag_features(np.zeros(1, np.int64), every[None], every[:, None], bits)[..., :-1]
    flat = [table.reshape(-1) for table in (weights, moved)]
    before = last = np.full(len(lanes), nothing)
    high = 0
    for count in np.bincount(steps).tolist():
        low, high = high, high + count
        before, last = (np.where(new[low:high], nothing, x[:count]) for x in (before, last))
        with_word = _place(
            FIXED_KINDS + TAG_KINDS - 1, hashed[low:high] ^ (last + 1).astype(np.uint64), bits)
        rows = np.concatenate((fixed[low:high], of_tags[last, before], with_word[:, None]), axis=1)
        guess = np.take(weights, rows, axis=0, mode="clip").sum(axis=1).argmax(axis=1)
        right = gold[low:high]
        step += count
        wrong = np.flatnonzero(guess != right)
        if len(wrong):
            for tags, sign in ((right, 1), (guess, -1)):
                cells = (rows[wrong] * nothing + tags[wrong, None]).reshape(-1)
                for table, amount in zip(flat, (by, step), strict=True):
                    np.add.at(table, cells, sign * amount)
        before, last = last, guess
    return step


def decode(tagger: Tagger, words: np.ndarray, endings: np.ndarray, marks: np.ndarray,
           starts: np.ndarray) -> np.ndarray:
    """Tag numbers of tokens whose sentences begin at ``starts``."""
    weights, bits = tagger.weights, tagger.bits
    found = np.empty(len(words), dtype=np.int64)
    scores = np.zeros((len(words), len(tagger.tags)), dtype=np.float32)
    for column in fixed_features(words, endings, marks, starts, bits).T:
        scores += weights[column]
    lengths = np.diff(np.r_[starts, len(words)])
    longest_first = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[longest_first], lengths[longest_first]
    before = last = np.full(len(starts), len(tagger.tags))
    for at in range(int(lengths[0]) if len(lengths) else 0):
        count = int(np.searchsorted(-lengths, -at, "left"))
        places = starts[:count] + at
        rows = tag_features(words[places], before[:count], last[:count], bits)
        best = (scores[places] + weights[rows].sum(axis=1)).argmax(axis=1)
        found[places] = best
        before, last = last[:count], best
    return found


def _blocks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows, or sentences, of about BLOCK tokens."""
    edges = np.r_[0, np.cumsum(sizes)]
    low = 0
    while low < len(sizes):
        high = max(int(np.searchsorted(edges, edges[low] + BLOCK, "left")), low + 1)
        yield low, min(high, len(sizes))
        low = high


def train(
    tagged: DataFrame, rows: int | None = None, per_row: int | None = None, epochs: int = EPOCHS,
    bits: int = BITS, folder: str | None = None,
) -> Tagger:
    """A tagger from columns ``tokens`` and ``tags``, two arrays of equal length.

    Learns from all rows, or at most ``per_row`` tokens of each. Rows without tokens, or with a
    NULL or missing tag, teach nothing. Digests of the tokens are written once, dealt to shards by
    all columns but arrays and by the digest of tokens and tags, to ``folder`` (by default a new
    one beside the session's other tables).

    With ``rows``, learns token by token from so many rows, chosen by the digests of their tokens
    and tags, in one task.
    """
    usable = tagged.filter(
        (F.size("tokens") > 0) & (F.size("tokens") == F.size("tags"))
        & ~F.exists("tags", lambda tag: tag.isNull())
    )
    if per_row is not None:
        usable = usable.withColumns(
            {name: F.slice(name, 1, per_row) for name in ("tokens", "tags")})
    if rows is not None:
        return _train_in_one_task(usable, rows, epochs, bits)
    return _train_in_shards(usable, epochs, bits, folder or work_folder(tagged.sparkSession))


def _train_in_one_task(usable: DataFrame, rows: int, epochs: int, bits: int) -> Tagger:
    columns = ["_words", "_endings", "_marks", "_tags"]
    usable = usable.select("tokens", "tags")
    drawn = usable.orderBy(F.xxhash64("tokens", "tags"), "tokens", "tags").limit(rows)
    sample = drawn.select(*_token_columns("tokens"), F.col("tags").alias("_tags"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = pd.concat([pd.DataFrame(columns=columns), *batches])
        tags = sorted({tag for row in table["_tags"] for tag in row})
        number = {tag: i for i, tag in enumerate(tags)}
        sentences = []
        for row in table.itertuples(index=False):
            words, endings, marks = (np.asarray(x) for x in row[:3])
            gold = np.array([number[tag] for tag in row[3]])
            starts = sentence_starts(marks, np.array([0]))
            fixed = fixed_features(words, endings, marks, starts, bits)
            for low, high in zip(starts, np.r_[starts[1:], len(words)], strict=True):
                sentences.append((words[low:high], fixed[low:high], gold[low:high]))
        weights = learn(sentences, tags, epochs, bits)
        yield pd.DataFrame({"tags": [tags], "weights": [weights.tobytes()]})

    model = sample.mapInPandas(run, "tags array<string>, weights binary").first()
    tags = list(model["tags"]) if model else []
    weights = np.frombuffer(model["weights"] if model else b"", np.float32)
    return Tagger(tags, weights.reshape(1 << bits if tags else 0, len(tags)))


def _write_shards(usable: DataFrame, tags: list[str], count: int, path: str) -> DataFrame:
    """Token columns and numbers of tags, a file for each shard, in an order that depends on
    nothing but the rows."""
    given = [name for name, kind in usable.dtypes
             if name not in ("tokens", "tags") and not kind.startswith(("array", "map", "struct"))]
    key = F.xxhash64("tokens", "tags")
    numbers = F.create_map(*[F.lit(x) for i, tag in enumerate(tags) for x in (tag, i)])
    dealt = usable.select(
        F.pmod(F.xxhash64(key, *given), F.lit(count)).cast("int").alias("_shard"),
        key.alias("_key"), *_token_columns("tokens"),
        F.transform("tags", lambda tag: F.element_at(numbers, tag)).alias("_tags"),
    ).withColumn("_marks", F.col("_marks").cast("array<tinyint>"))
    columns = ["_shard", "_key", "_words", "_endings", "_marks", "_tags"]
    shards = dealt.repartitionById(count, "_shard").sortWithinPartitions(*columns)
    shards.write.parquet(path)
    stored = usable.sparkSession.read.schema(shards.schema).parquet(path)
    return stored.select("_shard", *columns[2:])


def _blocks_of_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list]]:
    """(shard, number, parts): rows of about BLOCK tokens, whatever the batches; parts are the
    rows' sizes and their words, endings, marks and tags, one after the other."""
    shard, number, held, size = None, 0, [], 0

    def taken():
        return [np.concatenate(column) for column in zip(*held, strict=True)]

    for batch in batches:
        shards = batch.column(0).to_numpy(zero_copy_only=False)
        lists = batch.columns[1:]
        sizes = lists[0].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        edges = np.r_[0, np.cumsum(sizes)]
        parts = [column.flatten().to_numpy(zero_copy_only=False) for column in lists]
        low = 0
        while low < len(sizes):
            if held and shards[low] != shard:
                yield shard, number, taken()
                held, size = [], 0
            if shards[low] != shard:
                shard, number = int(shards[low]), 0
            last = low + int(np.searchsorted(shards[low:], shard, "right"))
            full = int(np.searchsorted(edges, edges[low] + BLOCK - size, "left"))
            high = min(max(full, low + 1), last)
            part = slice(edges[low], edges[high])
            held.append([sizes[low:high], *[values[part] for values in parts]])
            size += int(edges[high] - edges[low])
            if size >= BLOCK:
                yield shard, number, taken()
                held, size, number = [], 0, number + 1
            low = high
    if held:
        yield shard, number, taken()


def _train_in_shards(usable: DataFrame, epochs: int, bits: int, folder: str) -> Tagger:
    spark = usable.sparkSession
    found = usable.select(F.inline(F.transform(
        F.array_distinct("tags"), lambda tag, i: F.struct(
            tag.alias("tag"), F.when(i == 0, F.size("tokens")).otherwise(0).alias("n")))))
    counted = found.groupBy("tag").agg(F.sum("n").alias("n")).collect()
    if not counted:
        return Tagger([], np.empty((0, 0), np.float32))
    tags = sorted(row["tag"] for row in counted)
    count = -(-sum(row["n"] for row in counted) // SHARD)
    shards = _write_shards(usable, tags, count, f"{folder}/shards")
    shape = (1 << bits, len(tags))

    def epoch(number: int, shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            given, shard, at = shared.value, None, 0

            def learned():
                # Moves of all weights in ones, and how much they add to the sum of the weights
                # over all steps.
                moves = (weights - given) / count
                sums = moves * step - moved
                cells = np.flatnonzero((moves != 0) | (sums != 0))
                values = [x.reshape(-1)[cells].astype(np.int64) for x in (moves, sums)]
                cells, values = np.r_[-1, cells], [np.r_[step, values[0]], np.r_[0, values[1]]]
                for low in range(0, len(cells), BLOCK):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x[low : low + BLOCK]) for x in (cells, *values)],
                        names=["cell", "moves", "sums"])

            for of_shard, block, parts in _blocks_of_shards(batches):
                if of_shard != shard:
                    if shard is not None:
                        yield from learned()
                    shard, weights, moved, step = of_shard, given.copy(), np.zeros(shape), 0
                sizes, words, endings, marks, gold = parts
                starts = sentence_starts(marks, np.cumsum(sizes) - sizes)
                # A row of any length is learned from in blocks too.
                ends = np.r_[starts, len(words)]
                for part, (low, high) in enumerate(_blocks(np.diff(ends))):
                    one = slice(ends[low], ends[high])
                    begins = starts[low:high] - ends[low]
                    fixed = fixed_features(words[one], endings[one], marks[one], begins, bits)
                    order = np.random.default_rng([1, number, shard, block, part])
                    step = learn_side_by_side(
                        weights, moved, step, count, (words[one], fixed, gold[one], begins), bits,
                        order)
            if shard is not None:
                yield from learned()

        moves = shards.mapInArrow(run, "cell bigint, moves bigint, sums bigint")
        return moves.groupBy("cell").agg(F.sum("moves").alias("moves"), F.sum("sums").alias("sums"))

    # Weights are kept times the number of shards: whole numbers, as their mean is not.
    weights, total, steps = np.zeros(shape), np.zeros(shape), 0
    for number in range(epochs):
        shared = spark.sparkContext.broadcast(weights)
        mixed = epoch(number, shared).toArrow()
        shared.destroy()
        cells, moves, sums = (column.to_numpy() for column in mixed.columns)
        own = cells >= 0
        met = int(moves[~own].sum())
        steps += met
        total += weights * met
        total.reshape(-1)[cells[own]] += sums[own] * float(count)
        weights = weights.copy()
        weights.reshape(-1)[cells[own]] += moves[own]
    return Tagger(tags, (total / (steps * float(count))).astype(np.float32))


def tag(corpus: DataFrame, tagger: Tagger, tokens: str = "tokens") -> DataFrame:
    """Add ``pos``: a tag for each token of the array ``tokens``.

    NULL has no tags; a tagger that has seen none gives NULL tags.
    """
    if not tagger.tags:
        return corpus.withColumn("pos", F.transform(tokens, lambda t: F.lit(None).cast("string")))
    # One array of fixed size.
    shared = corpus.sparkSession.sparkContext.broadcast(tagger)

    @F.pandas_udf("array<int>")
    def tags(words: pd.Series, endings: pd.Series, marks: pd.Series) -> pd.Series:
        sizes = np.array([0 if row is None else len(row) for row in words])
        found = []
        for low, high in _blocks(sizes):
            edges = np.r_[0, np.cumsum(sizes[low:high])]
            parts = [
                np.concatenate([np.empty(0, kind), *[r for r in column[low:high] if r is not None]])
                .astype(kind)
                for column, kind in ((words, np.int64), (endings, np.int64), (marks, np.int32))
            ]
            starts = sentence_starts(parts[2], edges[:-1])
            numbers = decode(shared.value, *parts, starts).astype(np.int32)
            found += np.split(numbers, edges[1:-1])
        return pd.Series(found, dtype=object).where(words.notna().to_numpy(), None)

    names = F.array(*[F.lit(name) for name in tagger.tags])
    numbers = tags(*[column for column in _token_columns(tokens)])
    return corpus.withColumn("_numbers", numbers).withColumn(
        "pos", F.transform("_numbers", lambda number: F.get(names, number))
    ).drop("_numbers")
