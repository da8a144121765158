"""Prefix trie of conversations, in node tables behind minimal perfect hashes.

A node is a distinct sequence of first turns; its digest is a running sum of the turns'
digests times powers of an odd number, twice 64 bits, so that parts of a conversation that
lie in different shards can be put together.

1. Turns are range-sorted and numbered by running counts; conversations that span several
   parts of the sort get the counts of the parts before from a small table. The rebuilt
   conversations are sorted and summed up in the same way: every part is a shard of bounded
   size, and no conversation, however long, has to fit into one.
2. Each shard enumerates its distinct prefix digests and gives each a slot by a minimal
   perfect hash that verifies the digest in the slot. Members, smallest member and parent
   slot stand in flat arrays by slot. Counts are summed across shards by digest.
3. Of the whole trie, each node is owned by its smallest member, which also owns all of its
   own longer prefixes. A shard puts the weights of the nodes that its conversations own into
   their slots and adds every slot to its parent's, the deepest first. As each node of a
   subtree is owned by exactly one member of the subtree's top, the sums of all shards are
   the sums over subtrees. What enters a shard from later parts of a conversation comes from
   the small table.
4. The members that end in a node are range-sorted, written as decimal texts in pieces, and
   the pieces of a node are hashed one after the other.

Rows: a NULL conv_id is no conversation and is left out. NULL turns come first; turns with
equal numbers are ordered by role, then text, and repeated rows are turns each. NULL roles and
texts are empty. Columns other than conv_id, turn, role and text are not read. No rows give no
nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textstyle.llm.common import settle

# Conversations in groups of SHARED start alike; at most LONGEST - 1 turns are taken over.
SHARED, LONGEST = 5, 9
# Rows of a shard, about; members whose numbers make one piece of text.
SHARD, PIECE = 1 << 20, 1 << 13
# Odd multipliers of the two running sums and of the depth.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
DEPTH = 0xD6E8FEB86659FD93
WORD = 1 << 64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class NodeTable:
    """Slots 0 .. n - 1 of n distinct digests (two words each).

    Digests that meet no other one at a level of the hash get the rank of their place there;
    the others go to the next level. ``slots`` finds a digest's slot and compares the digest
    that stands there, so foreign digests get -1.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.a, self.b = np.empty_like(a), np.empty_like(b)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, base = np.arange(len(a)), 0
        while len(left):
            size = len(left) + len(left) // 2 + 1
            place = self._place(a[left], b[left], len(self.levels), size)
            alone = np.bincount(place, minlength=size) == 1
            rank = base + np.cumsum(alone) - 1
            self.levels.append((alone, rank))
            met = alone[place]
            self.a[rank[place[met]]] = a[left[met]]
            self.b[rank[place[met]]] = b[left[met]]
            base += int(alone.sum())
            left = left[~met]

    @staticmethod
    def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((level + 1) * FACTORS[0] % WORD)
        return (mix(a + mix(b ^ seed)) % np.uint64(size)).astype(np.int64)

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        found = np.full(len(a), -1, dtype=np.int64)
        left = np.arange(len(a))
        for level, (alone, rank) in enumerate(self.levels):
            place = self._place(a[left], b[left], level, len(alone))
            met = alone[place]
            found[left[met]] = rank[place[met]]
            left = left[~met]
        met = found >= 0
        met[met] = (self.a[found[met]] == a[met]) & (self.b[found[met]] == b[met])
        return np.where(met, found, -1)


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where each row's run of equal keys starts."""
    new = np.r_[True, keys[1:] != keys[:-1]]
    return np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))


def _powers(factor: int, size: int) -> np.ndarray:
    steps = np.full(size, factor, dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


SUMS = "part long, conv long, n long, s1 long, s2 long, bytes long"


def _summed(rows: DataFrame, order: list[str], schema: str, shard: int, name: str) -> DataFrame:
    """``rows`` in order, over parts of about ``shard`` rows: part, number within the
    conversation and the part, and running sums of c1 and c2 there if ``schema`` has them."""
    columns = [part.split()[0] for part in schema.split(", ")]
    sums = "s1" in columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seen = TaskContext.get().partitionId() << 32, 0
        last, count, totals = None, 0, [np.uint64(0)] * 2
        for batch in batches:
            if not len(batch):
                continue
            if seen >= shard:
                part, seen, last = part + 1, 0, None
            seen += len(batch)
            conv = batch["conv"].to_numpy()
            start = _runs(conv)
            n = np.arange(len(conv)) - start + 1
            goes_on = (start == 0) & (conv[0] == last)
            n += np.where(goes_on, count, 0)
            out = {"part": part, "n": n}
            for i, factor in enumerate(FACTORS if sums else ()):
                # Places of the running conversation may lie far from its start.
                power = _powers(factor, int(n.max()) + 1)
                terms = batch[f"c{i + 1}"].to_numpy().view(np.uint64) * power[n - 1]
                total = np.cumsum(terms, dtype=np.uint64)
                total -= np.where(start > 0, total[start - 1], np.uint64(0))
                total += np.where(goes_on, totals[i], np.uint64(0))
                totals[i] = total[-1]
                out[f"s{i + 1}"] = total.view(np.int64)
            last, count = conv[-1], int(n[-1])
            yield batch.assign(**out)[columns]

    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return settle(ordered.mapInPandas(run, schema), name)


def _spanning(rows: DataFrame, values: list[Column]) -> DataFrame:
    """(conv, part, *values) of the conversations that lie in several parts: these end or
    begin their parts, so there are at most two of them per part."""
    edges = rows.groupBy("part").agg(F.min("conv").alias("low"), F.max("conv").alias("high"))
    at = edges.select("part", F.explode(F.array_distinct(F.array("low", "high"))).alias("conv"))
    several = at.groupBy("conv").agg(F.count("*").alias("parts")).filter("parts > 1")
    at = settle(at.join(several.select("conv"), "conv"), "trie-spans")
    return rows.join(F.broadcast(at), ["part", "conv"]).groupBy("conv", "part").agg(*values)


def _earlier(column: str) -> Column:
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(before), F.lit(0))


def turn_rows(conversations: DataFrame, shard: int = SHARD) -> DataFrame:
    """(conv, pos, c1, c2, bytes): numbered turns with two digests and the text's length."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"),
        text.alias("text"),
    ).filter("conv IS NOT NULL").select(
        "*", F.xxhash64("role", "text").alias("c1"),
        F.xxhash64(F.lit("second"), "text", "role").alias("c2"),
        F.octet_length("text").cast("long").alias("bytes"),
        # Rows equal in all else may be many.
        F.monotonically_increasing_id().alias("row"),
    )
    numbered = _summed(
        rows, ["conv", "turn", "role", "text", "row"],
        "part long, conv long, n long, c1 long, c2 long, bytes long", shard, "trie-turns",
    )
    spans = _spanning(numbered, [F.max("n").alias("total")])
    before = spans.select("conv", "part", _earlier("total").alias("before"))
    # At most two rows per part.
    return numbered.join(F.broadcast(before), ["part", "conv"], "left").select(
        "conv", (F.col("n") + F.coalesce("before", F.lit(0))).alias("pos"), "c1", "c2", "bytes"
    )


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv, src, pos, c1, c2, bytes): a row before all turns of each conversation, the turns
    taken over from the first of its group, its own later ones."""
    taken = F.crc32(F.col("conv").cast("string").cast("binary")) % LONGEST
    first = F.col("conv") % SHARED == 0
    heads = turns.filter(first & (F.col("pos") < LONGEST)).groupBy("conv").agg(
        # At most LONGEST - 1 turns.
        F.sort_array(F.collect_list(F.struct("pos", "c1", "c2", "bytes"))).alias("turns")
    ).select(F.col("conv").alias("base"), "turns")
    convs = turns.filter("pos = 1").select("conv")
    none = F.lit(0).cast("long")
    roots = convs.select("conv", F.lit(0).alias("src"), none.alias("pos"), none.alias("c1"),
                         none.alias("c2"), none.alias("bytes"))
    others = convs.filter(~first).select(
        "conv", (F.col("conv") - F.col("conv") % SHARED).alias("base"), taken.alias("taken")
    )
    moved = others.join(heads, "base").select(
        "conv", F.lit(1).alias("src"),
        F.inline(F.slice("turns", F.lit(1), F.col("taken").cast("int"))),
    )
    own = turns.filter(first | (F.col("pos") > taken)).select(
        "conv", F.lit(2).alias("src"), "pos", "c1", "c2", "bytes"
    )
    return roots.union(moved).union(own)


CARRY = "conv long, part long, before long, b1 long, b2 long, more boolean"


def _carries(rows: DataFrame) -> DataFrame:
    """What the parts of a spanning conversation bring to its next part."""
    ends = F.max_by(F.struct("n", "s1", "s2"), "n").alias("end")
    spans = _spanning(rows, [ends]).select("conv", "part", "end.*")

    def carry(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        before, sums, out = 0, [0, 0], []
        for i, row in enumerate(group.itertuples()):
            signed = [s - WORD if s >= WORD // 2 else s for s in sums]
            out.append((row.conv, row.part, before, *signed, i + 1 < len(group)))
            sums = [(s + pow(f, before, WORD) * (x % WORD)) % WORD
                    for s, f, x in zip(sums, FACTORS, (row.s1, row.s2), strict=True)]
            before += row.n
        return pd.DataFrame(out, columns=[c.split()[0] for c in CARRY.split(", ")])

    # A group has one row per part of its conversation.
    return settle(spans.groupBy("conv").applyInPandas(carry, CARRY), "trie-carries")


LOCAL = ("part long, slot long, parent long, depth long, k1 long, k2 long, p1 long, p2 long, "
         "members long, conv long, more boolean, bytes long, leaves_part boolean")
ENDS = -1


def local_nodes(rows: pd.DataFrame, carries: pd.DataFrame) -> pd.DataFrame:
    """The node table of a shard, and with slot -1 the conversations that end there."""
    columns = [c.split()[0] for c in LOCAL.split(", ")]
    if not len(rows):
        return pd.DataFrame(columns=columns)
    rows = rows.sort_values(["conv", "n"])
    conv = rows["conv"].to_numpy()
    start = _runs(conv)
    last = np.r_[conv[1:] != conv[:-1], True]
    before = np.zeros(len(conv), dtype=np.int64)
    sums = [rows[s].to_numpy().view(np.uint64).copy() for s in ("s1", "s2")]
    goes_on, leaves_part = ~last, np.zeros(len(conv), dtype=bool)
    for row in carries.itertuples():
        mine = slice(*np.searchsorted(conv, (row.conv, row.conv + 1)))
        before[mine] = row.before
        for total, factor, carried in zip(sums, FACTORS, (row.b1, row.b2), strict=True):
            total[mine] = total[mine] * np.uint64(pow(factor, row.before, WORD)) + np.uint64(
                carried % WORD)
        if row.more:
            goes_on[mine.stop - 1] = leaves_part[mine.stop - 1] = True
    depth = rows["n"].to_numpy() + before - 1
    k1, k2 = sums[0] + depth.astype(np.uint64) * np.uint64(DEPTH), sums[1]
    # A conversation that began in an earlier part is a tree of its own here.
    tree = k1 ^ np.where(before > 0, np.uint64(FACTORS[1]), np.uint64(0))
    distinct = ~pd.DataFrame({"a": tree, "b": k2}).duplicated().to_numpy()
    table = NodeTable(tree[distinct], k2[distinct])
    slots = table.slots(tree, k2)
    size = int(distinct.sum())
    node = np.empty(size, dtype=np.int64)
    # Rows are in order of conv, so the first row of a node has its smallest member.
    node[slots[distinct]] = np.flatnonzero(distinct)
    goes = np.zeros(size, dtype=bool)
    goes[slots[goes_on]] = True
    out_of_part = np.zeros(size, dtype=bool)
    out_of_part[slots[leaves_part]] = True
    has_parent = (start < np.arange(len(conv)))[node]
    above = np.where(has_parent, node - 1, node)
    parents = [np.where(has_parent, k[above], 0).astype(np.uint64) for k in (k1, k2)]
    for row in carries.itertuples():
        at = np.searchsorted(conv, row.conv)
        if row.before and at < len(conv) and conv[at] == row.conv:
            parents[0][slots[at]] = (row.b1 + (row.before - 1) * DEPTH) % WORD
            parents[1][slots[at]] = np.uint64(row.b2 % WORD)
    part = int(rows["part"].iloc[0])
    nodes = pd.DataFrame({
        "part": part, "slot": np.arange(size),
        "parent": np.where(has_parent, slots[above], -1), "depth": depth[node],
        "k1": k1[node].view(np.int64), "k2": k2[node].view(np.int64),
        "p1": parents[0].view(np.int64), "p2": parents[1].view(np.int64),
        "members": np.bincount(slots, minlength=size), "conv": conv[node], "more": goes,
        "bytes": rows["bytes"].to_numpy()[node], "leaves_part": out_of_part,
    })
    ended = ~goes_on
    ends = pd.DataFrame({
        "part": part, "slot": ENDS, "parent": -1, "depth": depth[ended],
        "k1": k1[ended].view(np.int64), "k2": k2[ended].view(np.int64), "p1": 0, "p2": 0,
        "members": 0, "conv": conv[ended], "more": False, "bytes": 0, "leaves_part": False,
    })
    return pd.concat([nodes, ends])[columns]


NODES = ("k1 long, k2 long, p1 long, p2 long, depth long, conv long, n long, saved long, "
         "leaves long, children long")


def subtree_sums(nodes: pd.DataFrame, weights: pd.DataFrame) -> pd.DataFrame:
    """A shard's share of every node's sums: its weights, added to the parents' slots from the
    deepest nodes upwards."""
    columns = [c.split()[0] for c in NODES.split(", ")]
    if not len(nodes):
        return pd.DataFrame(columns=columns)
    nodes = nodes.sort_values("slot")
    parent, depth = nodes["parent"].to_numpy(), nodes["depth"].to_numpy()
    entering, owned = weights[weights["slot"] < 0], weights[weights["slot"] >= 0]
    at = owned["slot"].to_numpy()
    mine = np.zeros(len(nodes), dtype=bool)
    mine[at] = True
    sums = {}
    for name in ("saved", "leaves"):
        sums[name] = np.zeros(len(nodes), dtype=np.int64)
        sums[name][at] = owned[name].to_numpy()
        if len(entering):
            exits = np.flatnonzero(nodes["leaves_part"].to_numpy())
            sums[name][exits] += entering[name].to_numpy().sum()
    order = np.argsort(depth, kind="stable")
    edges = np.flatnonzero(np.r_[True, depth[order][1:] != depth[order][:-1], True])
    for low, high in zip(edges[-2::-1], edges[:0:-1], strict=True):
        level = order[low:high]
        level = level[parent[level] >= 0]
        for values in sums.values():
            np.add.at(values, parent[level], values[level])
    inside = mine & (parent >= 0)
    children = np.bincount(parent[inside], minlength=len(nodes))
    n, conv = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
    n[at], conv[at] = owned["n"].to_numpy(), owned["conv"].to_numpy()
    out = nodes[["k1", "k2", "p1", "p2", "depth"]].assign(
        conv=pd.arrays.IntegerArray(conv, ~mine), n=n, saved=sums["saved"],
        leaves=sums["leaves"], children=children,
    )
    # The parent of a conversation's first row here lies in an earlier part.
    strayed = nodes[mine & (parent < 0) & (depth > 0)]
    if len(strayed):
        out = pd.concat([out, pd.DataFrame({
            "k1": strayed["p1"], "k2": strayed["p2"], "p1": None, "p2": None, "depth": None,
            "conv": None, "n": 0, "saved": 0, "leaves": 0, "children": 1,
        }).astype({c: "Int64" for c in ("p1", "p2", "depth", "conv")})])
    return out[columns]


def _ending_members(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of the nodes in which members end."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            a, b = batch["k1"].to_numpy(), batch["k2"].to_numpy()
            new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
            first = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
            edges = np.flatnonzero((np.arange(len(a)) - first) % PIECE == 0)
            names = batch["conv"].astype(str).to_numpy()
            texts = [",".join(names[low:high]) for low, high in
                     zip(edges, np.r_[edges[1:], len(a)], strict=True)]
            yield pd.DataFrame({"k1": a[edges], "k2": b[edges],
                                "place": number + np.arange(len(edges)), "text": texts})
            number += len(edges)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, digest = None, None
        for batch in batches:
            out = []
            for row in batch.itertuples():
                if (row.k1, row.k2) == key:
                    digest.update(b"," + row.text.encode())
                    continue
                if key:
                    out.append((*key, digest.hexdigest()))
                key, digest = (row.k1, row.k2), hashlib.sha256(row.text.encode())
            yield pd.DataFrame(out, columns=["k1", "k2", "ends_sha256"])
        if key:
            yield pd.DataFrame([(*key, digest.hexdigest())], columns=["k1", "k2", "ends_sha256"])

    order = ["k1", "k2", "conv"]
    texts = settle(
        ends.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInPandas(pieces, "k1 long, k2 long, place long, text string"), "trie-ends",
    )
    return texts.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "place").mapInPandas(
        hashed, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, shard: int = SHARD) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    rows = _summed(rebuilt(turn_rows(conversations, shard)), ["conv", "src", "pos"], SUMS, shard,
                   "trie-rows")
    carries = _carries(rows)
    local = settle(
        rows.groupBy("part").cogroup(carries.groupBy("part")).applyInPandas(local_nodes, LOCAL),
        "trie-local",
    )
    nodes = local.filter(F.col("slot") >= 0)
    owned = nodes.groupBy("k1", "k2").agg(
        F.sum("members").alias("n"), F.min(F.struct("conv", "part", "slot")).alias("owner"),
        F.max("more").alias("more"), F.max("bytes").alias("bytes"),
    )
    weights = settle(owned.select(
        "owner.part", "owner.slot", "owner.conv", "n",
        ((F.col("n") - 1) * F.col("bytes")).alias("saved"),
        (~F.col("more")).cast("long").alias("leaves"),
    ), "trie-weights")
    # At most two rows per part.
    inside = weights.join(F.broadcast(carries.select("conv", "part")), ["conv", "part"]).groupBy(
        "conv", "part").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    every = carries.select("conv", "part").join(inside, ["conv", "part"], "left").na.fill(0)
    later = Window.partitionBy("conv").orderBy(F.desc("part")).rowsBetween(
        Window.unboundedPreceding, -1)
    entering = every.select(
        "part", F.lit(-1).cast("long").alias("slot"), "conv", F.lit(0).cast("long").alias("n"),
        F.sum("saved").over(later).alias("saved"), F.sum("leaves").over(later).alias("leaves"),
    ).filter("saved IS NOT NULL")
    shares = nodes.groupBy("part").cogroup(weights.union(entering).groupBy("part"))
    summed = settle(
        shares.applyInPandas(subtree_sums, NODES).groupBy("k1", "k2").agg(
            F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("depth").alias("depth"),
            F.max("conv").alias("conv"), F.max("n").alias("n"), F.sum("saved").alias("saved"),
            F.sum("leaves").alias("leaves"), F.sum("children").alias("children"),
        ), "trie-nodes",
    )
    parents = summed.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                            F.col("conv").alias("parent_conv_id"))
    below = summed.filter("depth > 0").join(parents, ["p1", "p2"])
    top = summed.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    ends = _ending_members(local.filter(F.col("slot") == ENDS).select("k1", "k2", "conv"))
    nothing = hashlib.sha256(b"").hexdigest()
    return below.unionByName(top).join(ends, ["k1", "k2"], "left").select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
