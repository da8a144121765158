"""Exact top-k by inner product with the threshold algorithm.

Every shard keeps, for each dimension, the list of its rows sorted by that component. For a
query all lists are read in step, from the end where the component adds most; each row met
is scored in full. The sum of what the lists offer at the depth reached bounds every row
not met yet: once it is below the k-th best score the shard is done. Ties of bound and k-th
score go on, since an unseen row could have the smaller id.

Rows: vectors that are NULL, empty or hold NULL or non-finite components take no part, nor
rows without id. Queries meet vectors of their own length. A query's own id is no candidate,
also where it is repeated. Equal scores go to the smaller id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from textstyle.llm import vectors

SCALE = 256
# Rows of a shard, queries of a block, list entries read between two looks at the bound.
PER_SHARD, PER_BLOCK, STEP = 8192, 128, 64


def quantise(values: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * values)


def _shard(group: pd.DataFrame) -> dict:
    values = quantise(vectors.matrix(group))
    lists = np.argsort(-values, axis=0, kind="stable").T.astype("<i4")
    return {"values": values.tobytes(), "lists": np.ascontiguousarray(lists).tobytes()}


def best_of(values: np.ndarray, lists: np.ndarray, ids: np.ndarray, query: np.ndarray,
            own: int, k: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores of the k best rows, and how many rows were scored."""
    count = len(ids)
    seen = ids == own
    left = count - int(seen.sum())
    dims = np.flatnonzero(query)
    if not len(dims):
        dims = np.arange(1)
    rising = query[dims] < 0
    best_ids, best = np.empty(0, np.int64), np.empty(0)
    scored = 0
    for depth in range(0, count, step):
        until = min(depth + step, count)
        ahead = np.arange(depth, until)
        at = np.where(rising[:, None], count - 1 - ahead, ahead)
        met = lists[dims[:, None], at]
        new = np.unique(met[~seen[met]])
        seen[new] = True
        scored += len(new)
        scores = values[new] @ query
        if len(best) == k:
            scores, new = scores[scores >= best[-1]], new[scores >= best[-1]]
        all_ids, every = np.concatenate([best_ids, ids[new]]), np.concatenate([best, scores])
        order = np.lexsort((all_ids, -every))[:k]
        best_ids, best = all_ids[order], every[order]
        bound = float(values[met[:, -1], dims] @ query[dims])
        if scored == left or len(best) == k and bound < best[-1]:
            break
    return best_ids, best, scored


def top_k(table: DataFrame, every: int = 50, k: int = 5, per_shard: int = PER_SHARD,
          per_block: int = PER_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose id is divisible by ``every``.

    Scores are sums of products of whole numbers, exact up to 2 ** 53.
    """
    def answer(shard: dict, ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple]:
        rows = np.frombuffer(shard["ids"], "<i8")
        values = np.frombuffer(shard["values"]).reshape(len(rows), -1)
        lists = np.frombuffer(shard["lists"], "<i4").reshape(-1, len(rows))
        for own, query in zip(ids.tolist(), quantise(queries), strict=True):
            found, scores, _ = best_of(values, lists, rows, query, own, k)
            yield from zip([own] * len(found), found.tolist(), scores.astype(np.int64).tolist(),
                           strict=True)

    rows = vectors.numbered(table, zeros=True)
    return vectors.search(rows, every, k, per_shard, per_block, _shard,
                          "values binary, lists binary", answer, "long")
