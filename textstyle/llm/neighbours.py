"""Nearest neighbours by inner product in vantage-point trees, one per shard.

Inner products become distances: each vector gets one more component that fills its norm up
to the shard's largest, queries get 0 there; the nearest by Euclidean distance is then the
one with the largest inner product. A node halves its rows by their distance to a vantage
point; the half a query lies in is searched first, the other one only if the query's
distance to the border is within ``factor`` times the k-th best distance so far. With factor
one the triangle inequality makes the search exact, a smaller one prunes more.

Rows: vectors that are NULL, zero, empty or hold NULL or non-finite components take no part,
nor rows without id. Queries meet vectors of their own length. A query's own id is no
candidate, also where it is repeated. Equal scores go to the smaller id. Scores are taken
anew from the original vectors. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from textstyle.llm import vectors

PER_SHARD, PER_BLOCK, LEAF = 8192, 512, 128
# Chosen by the recall measured against brute force, see the README.
FACTOR = 0.3


def build(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows in the leaves, and the nodes in pre-order.

    A node is (first row, end row, vantage row, border, number of the second child); a
    leaf's border is not a number. Halves are equal in size whatever the ties.
    """
    nodes: list[list[float]] = []
    random = np.random.default_rng(len(points))

    def split(rows: np.ndarray, first: int) -> np.ndarray:
        node = [first, first + len(rows), -1, np.nan, -1]
        nodes.append(node)
        if len(rows) <= leaf:
            return rows
        vantage = rows[random.integers(len(rows))]
        distance = np.linalg.norm(points[rows] - points[vantage], axis=1)
        order = np.argsort(distance, kind="stable")
        half = len(rows) // 2
        node[2], node[3] = vantage, distance[order[half]]
        near = split(rows[order[:half]], first)
        node[4] = len(nodes)
        far = split(rows[order[half:]], first + half)
        return np.concatenate([near, far])

    order = split(np.arange(len(points)), 0)
    return order, np.array(nodes, dtype=np.float64)


def lifted(points: np.ndarray) -> np.ndarray:
    squares = (points**2).sum(axis=1)
    rest = np.sqrt(np.maximum(squares.max() - squares, 0))
    return np.column_stack([points, rest])


def _shard(group: pd.DataFrame) -> dict:
    points = vectors.matrix(group)
    order, nodes = build(lifted(points))
    return {"points": points.tobytes(), "order": order.astype("<i8").tobytes(),
            "nodes": nodes.tobytes()}


class Search:
    """The k best rows of one shard for a block of queries, all queries of a node at once."""

    def __init__(self, points, ids, order, nodes, queries, own, k, factor):
        self.lifted = lifted(points)
        self.points, self.ids, self.order, self.nodes = points, ids, order, nodes
        self.queries, self.own, self.k, self.factor = queries, own, k, factor
        self.placed = points[order]
        self.placed_ids = ids[order]
        self.best = np.full((len(queries), k), -np.inf)
        self.rows = np.full((len(queries), k), -1, dtype=np.int64)
        self.norms = (queries**2).sum(axis=1)
        self.largest = (points**2).sum(axis=1).max()
        self.compared = 0

    def radius(self, active: np.ndarray) -> np.ndarray:
        """Distance of each query's k-th best row; infinite while there are fewer."""
        square = self.largest + self.norms[active] - 2 * self.best[active, -1]
        return np.sqrt(np.maximum(square, 0))

    def leaf(self, first: int, end: int, active: np.ndarray) -> None:
        self.compared += (end - first) * len(active)
        scores = np.round(self.queries[active] @ self.placed[first:end].T, 12)
        ids = self.placed_ids[first:end]
        scores[self.own[active][:, None] == ids[None, :]] = -np.inf
        better = scores.max(axis=1) >= self.best[active, -1]
        active, scores = active[better], scores[better]
        if not len(active):
            return
        every = np.concatenate([self.best[active], scores], axis=1)
        places = np.broadcast_to(np.arange(first, end), scores.shape)
        rows = np.concatenate([self.rows[active], places], axis=1)
        ties = np.where(rows < 0, np.iinfo(np.int64).max, self.placed_ids[rows])
        order = np.lexsort((ties, -every), axis=1)[:, : self.k]
        self.best[active] = np.take_along_axis(every, order, axis=1)
        self.rows[active] = np.take_along_axis(rows, order, axis=1)

    def visit(self, number: int, active: np.ndarray) -> None:
        if not len(active):
            return
        first, end, vantage, border, second = self.nodes[number]
        if np.isnan(border):
            self.leaf(int(first), int(end), active)
            return
        point = self.lifted[int(vantage)]
        apart = self.queries[active] - point[:-1]
        distance = np.sqrt((apart**2).sum(axis=1) + point[-1] ** 2)
        inside = distance < border
        self.visit(number + 1, active[inside])
        self.visit(int(second), active[~inside])
        reach = np.abs(distance - border) <= self.factor * self.radius(active)
        self.visit(int(second), active[inside & reach])
        self.visit(number + 1, active[~inside & reach])

    def run(self) -> Iterator[tuple]:
        self.visit(0, np.arange(len(self.queries)))
        for own, query, rows, best in zip(self.own.tolist(), self.queries, self.rows, self.best,
                                          strict=True):
            rows = rows[np.isfinite(best)]
            scores = (self.placed[rows] * query).sum(axis=1)
            yield from zip([own] * len(rows), self.placed_ids[rows].tolist(), scores.tolist(),
                           strict=True)


def nearest(table: DataFrame, every: int = 20, k: int = 20, factor: float = FACTOR,
            per_shard: int = PER_SHARD, per_block: int = PER_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose id is divisible by ``every``."""
    def answer(shard: dict, own: np.ndarray, queries: np.ndarray) -> Iterator[tuple]:
        ids = np.frombuffer(shard["ids"], "<i8")
        points = np.frombuffer(shard["points"]).reshape(len(ids), -1)
        order = np.frombuffer(shard["order"], "<i8")
        nodes = np.frombuffer(shard["nodes"]).reshape(-1, 5)
        return Search(points, ids, order, nodes, queries, own, k, factor).run()

    rows = vectors.numbered(table, zeros=False)
    return vectors.search(rows, every, k, per_shard, per_block, _shard,
                          "points binary, order binary, nodes binary", answer, "double")
