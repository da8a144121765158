"""Near duplicates by BagMinHash signatures of word shingles.

A text is the bag of its shingles of five words, each as heavy as it is frequent. Weights
are cut at 1, 2, 4, 8 ... Every shingle has one Poisson process per interval between cuts
that its weight reaches, with the interval's length as rate; of the interval that the
weight ends in, points beyond the weight are left out. Points come in order of time and
fall into one of the registers; each register keeps its first time, and processes end once
they are behind all registers. Two bags agree in a register with a probability equal to
their weighted Jaccard similarity.

Registers are banded. In each bucket the text with the most exact copies is the head; all
others are compared with it, and texts that are linked then form components. Buckets that
still hold several components are cut into blocks of bounded size; each two blocks meet in
a task of their own, which multiplies their bags and hands on only links that join two
components. So no pair that shares a bucket is lost, and no list of all pairs is made. A
link is an overlap of the bags, counted on the words themselves, of 0.8 or more of their
union.

Rows: equal texts are one class. Texts of one to four words have one shingle, all their
words. Texts without words, NULL among them, are a class each by themselves. Rows with one
id and different texts are told apart; repeated rows share their class. Ids that are NULL
name no class unless there is no other id; their texts are linked like all others. Texts may be
of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textstyle.llm.common import arrow_batches, fresh, settle
from textstyle.llm.components import components

SHINGLE, SIMILAR = 5, 0.8
BANDS, BAND = 25, 5
REGISTERS = BANDS * BAND
# Texts of an open bucket that one block holds about, and shingles multiplied at once.
BLOCK, MULTIPLIED = 512, 40_000
# Shingles whose processes run side by side in one task.
TOGETHER = 200_000

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit value of each 64-bit value."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """A number in (0, 1) of each 64-bit value."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles and their counts."""
    parts = text.encode("utf-8", "surrogatepass").split()
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    word = np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))
    width = min(SHINGLE, len(word))
    hashed = np.zeros(len(word) - width + 1, np.uint64)
    for at in range(width):
        hashed = mixed(hashed * GOLDEN + word[at : at + len(hashed)])
    return np.unique(hashed, return_counts=True)


def signatures(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray,
               bags: int, registers: int = REGISTERS) -> np.ndarray:
    """The registers of each bag: one row per bag, the time of the first point."""
    times = np.full(bags * registers, np.inf)
    # One process per shingle and interval of weights that it reaches.
    levels = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    process = np.repeat(np.arange(len(shingle)), levels)
    level = np.arange(len(process)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    rate = np.where(level > 0, 2.0 ** (level - 1), 1.0)
    state = mixed(shingle[process] + GOLDEN * level.astype(np.uint64))
    owner, weight = owner[process], weight[process]
    now = np.zeros(len(process))
    while len(owner):
        state = state + GOLDEN
        draw = mixed(state)
        now = now - np.log(unit(draw)) / rate
        second = mixed(draw + GOLDEN)
        register = (second % np.uint64(registers)).astype(np.int64)
        reached = low + rate * unit(mixed(second + GOLDEN)) < weight
        np.minimum.at(times, owner[reached] * registers + register[reached], now[reached])
        last = times.reshape(bags, registers).max(axis=1)
        on = now < last[owner]
        owner, weight, now, state = owner[on], weight[on], now[on], state[on]
        low, rate = low[on], rate[on]
    return times.reshape(bags, registers)


def band_keys(times: np.ndarray) -> np.ndarray:
    bits = times.view(np.uint64).reshape(len(times), BANDS, BAND)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bits.shape[:2])
    for at in range(BAND):
        keys = mixed(keys * GOLDEN + bits[:, :, at])
    return keys.view(np.int64)


def signed(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(place, size of the bag, band keys) of each text with words."""
    waiting: list[tuple] = []

    def close() -> Iterator[tuple[int, int, np.ndarray]]:
        counts = [len(s) for _, s, _ in waiting]
        owner = np.repeat(np.arange(len(waiting)), counts)
        keys = band_keys(signatures(
            owner, np.concatenate([s for _, s, _ in waiting]),
            np.concatenate([w for _, _, w in waiting]), len(waiting),
        ))
        for (place, _, weight), row in zip(waiting, keys, strict=True):
            yield place, int(weight.sum()), row

    total = 0
    for place, text in enumerate(texts):
        shingle, weight = bag(text)
        if len(shingle):
            waiting.append((place, shingle, weight))
            total += len(shingle)
        if total >= TOGETHER:
            yield from close()
            waiting, total = [], 0
    if waiting:
        yield from close()


def similar(a: str, b: str) -> bool:
    """Whether the bags overlap in 0.8 of their union, counted on the words."""
    a_words, b_words = (t.encode("utf-8", "surrogatepass").split() for t in (a, b))
    number = {word: i for i, word in enumerate(dict.fromkeys(a_words + b_words))}
    rows = []
    for part in (a_words, b_words):
        ids = np.fromiter(map(number.__getitem__, part), np.int64, len(part))
        width = min(SHINGLE, len(ids))
        if not width:
            return False
        table = np.full((len(ids) - width + 1, SHINGLE), -1)
        for at in range(width):
            table[:, at] = ids[at : at + len(table)]
        rows.append(table)
    _, place = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    place = place.ravel()
    left = np.bincount(place[: len(rows[0])], minlength=place.max() + 1)
    right = np.bincount(place[len(rows[0]):], minlength=place.max() + 1)
    common = int(np.minimum(left, right).sum())
    # Whole numbers: common / union >= 4 / 5.
    return 5 * common >= 4 * (len(place) - common)


def text_id(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _signatures(docs: DataFrame) -> DataFrame:
    """(text, n, bands) of every row whose text has words."""
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.drop_duplicates("text")
            found = list(signed(batch["content"].tolist()))
            if not found:
                continue
            yield pd.DataFrame({
                "text": [batch["text"].iloc[place] for place, _, _ in found],
                "n": [n for _, n, _ in found],
                "bands": [keys for _, _, keys in found],
            })

    return docs.select(text_id(F.col("text")).alias("text"), F.col("text").alias("content")).filter(
        "content is not null"
    ).mapInPandas(sign, "text binary, n long, bands array<long>")


def _contents(wanted: DataFrame, texts: DataFrame, docs: DataFrame) -> DataFrame:
    """(text, content) of the wanted texts: from one row of each that ``texts`` names; those
    without any id by their digests, from all rows without an id."""
    named = wanted.join(texts, "text")
    rows = docs.select(F.col("doc_id").alias("first"), F.col("text").alias("content"))
    digest = text_id(F.col("content"))
    by_id = (
        rows.join(named, "first").filter(digest == F.col("text"))
        .dropDuplicates(["text"]).select("text", "content")
    )
    unnamed = named.filter("first IS NULL").select("text")
    without_id = (
        rows.filter("first IS NULL").select(digest.alias("text"), "content").dropDuplicates(["text"])
    )
    return settle(by_id.union(without_id.join(unnamed, "text")), "near-contents")


def _compared(pairs: DataFrame, texts: DataFrame, docs: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with whether they are similar. ``texts`` names a row of each text."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("text")).distinct()
    contents = _contents(wanted, texts, docs)
    a = contents.select(F.col("text").alias("a"), F.col("content").alias("a_content"))
    b = contents.select(F.col("text").alias("b"), F.col("content").alias("b_content"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            linked = [similar(x, y) for x, y in zip(batch["a_content"], batch["b_content"],
                                                    strict=True)]
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "linked": linked})

    with arrow_batches(docs.sparkSession, 200):
        return settle(
            pairs.join(a, "a").join(b, "b").mapInPandas(
                compare, "a binary, b binary, linked boolean"
            ),
            "near-compared",
        )


def _may_match(a: str, b: str) -> Column:
    """Bags whose sizes differ too much cannot overlap enough."""
    return (5 * F.col(a) >= 4 * F.col(b)) & (5 * F.col(b) >= 4 * F.col(a))


def text_links(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): links between different texts that connect all classes."""
    with arrow_batches(docs.sparkSession, 2000):
        marked = settle(_signatures(docs), "near-signatures")
    copies = texts.select("text", "copies")
    one = marked.dropDuplicates(["text"]).join(copies, "text")
    entries = one.select("text", "n", "copies", F.explode("bands").alias("bucket"))
    bucket = Window.partitionBy("bucket")
    order = bucket.orderBy(F.desc("copies"), "text").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    lists = settle(
        entries.withColumn("length", F.count("*").over(bucket))
        .withColumn("head", F.first(F.struct("text", "n")).over(order))
        .filter("length > 1").select("bucket", "text", "n", "head"),
        "near-buckets",
    )
    tried = settle(
        lists.filter((F.col("head.text") != F.col("text")) & _may_match("head.n", "n"))
        .select(F.col("head.text").alias("a"), F.col("text").alias("b")).distinct(),
        "near-pairs",
    )
    first = _compared(tried, texts, docs)
    links = first.filter("linked").select("a", "b")
    labels = components(links)
    placed = lists.join(labels.withColumnRenamed("id", "text"), "text", "left").select(
        "bucket", "text", F.coalesce("label", "text").alias("label")
    )
    # Only buckets that hold several components have pairs left.
    several = placed.groupBy("bucket").agg(
        F.min("label").alias("least"), F.max("label").alias("most"), F.count("*").alias("members")
    ).filter("least <> most").select("bucket", "members")
    found = _block_links(settle(placed.join(several, "bucket"), "near-open"), texts, docs)
    second = _compared(settle(found.distinct(), "near-rest"), texts, docs)
    return links.union(second.filter("linked").select("a", "b"))


def _elements(text: str) -> bytes:
    """The bag as a set: the n-th occurrence of a shingle is an element of its own."""
    shingle, weight = bag(text)
    first = np.repeat(np.cumsum(weight) - weight, weight)
    place = (np.arange(len(first)) - first).astype(np.uint64)
    return np.sort(mixed(np.repeat(shingle, weight) + place * GOLDEN)).tobytes()


def _slices(sizes: np.ndarray) -> list[slice]:
    """Consecutive rows of together at most ``MULTIPLIED`` elements, or one row."""
    edges, total = [0], 0
    for place, size in enumerate(sizes.tolist()):
        if place > edges[-1] and total + size > MULTIPLIED:
            edges.append(place)
            total = 0
        total += size
    return [slice(a, b) for a, b in zip(edges, [*edges[1:], len(sizes)], strict=True)]


def block_pairs(sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Places of all pairs of sets that overlap in 0.8 or more of their union."""
    sizes = np.array([len(s) for s in sets])
    parts = _slices(sizes)
    for i, rows in enumerate(parts):
        for columns in parts[i:]:
            both = sets[rows] + sets[columns]
            _, element = np.unique(np.concatenate(both), return_inverse=True)
            owner = np.repeat(np.arange(len(both)), [len(s) for s in both])
            held = np.zeros((len(both), int(element.max()) + 1), np.float32)
            held[owner, element] = 1
            count = rows.stop - rows.start
            common = held[:count] @ held[count:].T
            union = sizes[rows][:, None] + sizes[columns][None, :] - common
            for a, b in zip(*np.nonzero(5 * common >= 4 * union), strict=True):
                if a + rows.start < b + columns.start:
                    yield a + rows.start, b + columns.start


def _block_links(opened: DataFrame, texts: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b): links that join two components of an open bucket, few for each component."""
    contents = _contents(opened.select("text").distinct(), texts, docs)

    def as_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"text": batch["text"],
                                "elements": [_elements(t) for t in batch["content"]]})

    with arrow_batches(docs.sparkSession, 500):
        bags = settle(contents.mapInPandas(as_sets, "text binary, elements binary"), "near-bags")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("text"), blocks.cast("long")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(
        F.least(F.col("own"), other).alias("i"), F.greatest(F.col("own"), other).alias("j")))
    dealt = opened.withColumn("blocks", blocks).withColumn("own", own).select(
        "bucket", "text", "label", F.inline(meets)
    )

    def links(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("text", kind="stable").reset_index(drop=True)
        names, root, found = group["text"].tolist(), {}, []

        def top(label: bytes) -> bytes:
            while root.get(label, label) != label:
                label = root[label]
            return label

        label = group["label"].tolist()
        sets = [np.frombuffer(e, np.uint64) for e in group["elements"]]
        for a, b in block_pairs(sets):
            one, other = top(label[a]), top(label[b])
            if one != other:
                root[max(one, other)] = min(one, other)
                found.append((names[a], names[b]))
        return pd.DataFrame(found, columns=["a", "b"])

    return dealt.join(bags, "text").groupBy("bucket", "i", "j").applyInPandas(
        links, "a binary, b binary"
    )


def near_classes(docs: DataFrame) -> DataFrame:
    """(text, first, label, class_id): for every text its least doc_id, the component it lies
    in, and the least doc_id of its class."""
    own = docs.select("doc_id", "text")
    texts = settle(
        own.filter(F.col("text").isNotNull())
        .groupBy(text_id(F.col("text")).alias("text"))
        .agg(F.count("*").alias("copies"), F.min("doc_id").alias("first")),
        "near-texts",
    )
    links = settle(text_links(own, texts), "near-links")
    labels = components(links)
    placed = texts.join(labels.withColumnRenamed("id", "text"), "text", "left").withColumn(
        "label", F.coalesce("label", "text")
    )
    ids = placed.groupBy("label").agg(F.min("first").alias("class_id"))
    return settle(
        placed.join(ids, "label").select("text", "first", "label", "class_id"), "near-classes"
    )


def _has_words(text: Column) -> Column:
    return F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


def classify(docs: DataFrame) -> DataFrame:
    """Every row's doc_id with the class_id of its text; its own id for texts without words."""
    classes = near_classes(docs).select("text", F.col("class_id").alias("found"))
    rows = docs.select("doc_id", text_id(F.col("text")).alias("text"),
                       _has_words(F.col("text")).alias("worded"))
    return rows.join(classes, "text", "left").select(
        "doc_id", F.when(F.col("worded"), F.col("found")).otherwise(F.col("doc_id")).alias("class_id")
    )


def drop_near(docs: DataFrame) -> DataFrame:
    """One document of each class: the one with the least doc_id; texts without words stay.

    Of rows repeated with that id and text one stays; only ids that are repeated are grouped.
    """
    kept_id, kept_text, kept_rows = fresh(docs, "kept_id", "kept_text", "kept_rows")
    named = near_classes(docs).filter(F.col("first").eqNullSafe(F.col("class_id")))
    # Where no text of a class has an id, or several have the least one, the least digest stays.
    keep = named.groupBy("label").agg(
        F.min("first").alias(kept_id), F.min("text").alias(kept_text)
    ).select(kept_id, kept_text)
    rows = docs.select(F.col("doc_id").alias(kept_id), text_id(F.col("text")).alias(kept_text))
    keep = settle(
        rows.join(keep, rows[kept_id].eqNullSafe(keep[kept_id])
                  & (rows[kept_text] == keep[kept_text]), "left_semi")
        .groupBy(kept_id, kept_text).agg(F.count("*").alias(kept_rows)),
        "near-keep",
    )
    worded = docs.filter(_has_words(F.col("text")))
    chosen = worded.join(
        keep, worded["doc_id"].eqNullSafe(keep[kept_id])
        & (text_id(worded["text"]) == keep[kept_text]),
    )
    once = chosen.filter(F.col(kept_rows) == 1).select(*docs.columns)
    repeated = chosen.filter(F.col(kept_rows) > 1).dropDuplicates([kept_id, kept_text]).select(
        *docs.columns
    )
    return once.union(repeated).union(docs.filter(~_has_words(F.col("text"))))
