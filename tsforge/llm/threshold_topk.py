"""Exact top-k inner products by Fagin's threshold algorithm over sorted per-dimension lists.

In a block each dimension has its vectors sorted by component. A query walks down all lists at
once, from the high end where its weight is positive and from the low end where it is
negative, and scores every vector it meets. What it has not met scores at most the sum of its
weights times the components reached; once that is below the kth best score the walk stops. The
kth score carries over to the next lists of the block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.llm.vectors import matrix, searched, usable


class SortedLists:
    """The vectors of one leaf and its sorted list per dimension."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.order = np.ascontiguousarray(np.argsort(x, axis=0, kind="stable").T)  # rising
        self.values = np.take_along_axis(x.T, self.order, axis=1)

    def walk(self, query: np.ndarray, own: int, k: int, top: tuple[np.ndarray, np.ndarray], step: int = 32) -> tuple[np.ndarray, np.ndarray]:
        """``top`` (scores, ids; best first, at most k) with what this leaf adds to it."""
        n = len(self.ids)
        up, down = np.flatnonzero(query < 0), np.flatnonzero(query > 0)
        seen = np.zeros(n, bool)
        skip = self.ids == own
        depth = 0
        while depth < n:
            # The last depth reached bounds what lies below; before the first step nothing is known.
            to = min(n, max(step, 2 * depth))
            fresh = np.zeros(n, bool)
            fresh[self.order[up, depth:to].ravel()] = True
            fresh[self.order[down, n - to : n - depth].ravel()] = True
            if to == n:
                fresh[:] = True
            fresh &= ~seen & ~skip
            seen |= fresh
            at = np.flatnonzero(fresh)
            if len(at):
                score = (self.x @ query)[at] if 4 * len(at) > n else self.x[at] @ query
                s, i = np.r_[top[0], score], np.r_[top[1], self.ids[at]]
                if len(s) > 4 * k:
                    keep = s >= np.partition(s, len(s) - k)[len(s) - k]
                    s, i = s[keep], i[keep]
                best = np.lexsort((i, -s))[:k]
                top = s[best], i[best]
            depth = to
            bound = query[up] @ self.values[up, to - 1] + query[down] @ self.values[down, n - to]
            # An equal score may still win by its id, so the bound must be lower.
            if len(top[0]) == k and bound < top[0][-1]:
                break
        return top


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, query_rows: int = 2048, block_rows: int = 8192, leaf_rows: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score long): the k largest inner products of floor(scale * x).

    Both tables have vec_id and embedding. A query's own id is no candidate; ties go to the
    smaller id. Null vectors, empty ones and those with a null, NaN or infinite component take
    no part; fewer than k candidates give all of them. Work is queries x candidates in the
    worst case, as the bound seldom drops early in many dimensions.
    """

    def whole(df: DataFrame) -> DataFrame:
        rows = usable(df).select("vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("v"))
        return rows.withColumn("dim", F.size("v"))

    def find(ask: pa.Table, own: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        dim = ask.column("dim")[0].as_py()
        q, x = matrix(ask, "v", dim), matrix(own, "v", dim)
        # Doubles hold these integers exactly, and their sums, up to 2**53.
        if float(np.abs(q).max()) * float(np.abs(x).max()) * dim < 2.0**53:
            q, x = q.astype(np.float64), x.astype(np.float64)
        qid, ids = ask.column("vec_id").to_numpy(), own.column("vec_id").to_numpy()
        leaves = [SortedLists(ids[i : i + leaf_rows], x[i : i + leaf_rows]) for i in range(0, len(ids), leaf_rows)]
        out_q, out_i, out_s = [], [], []
        for row, own_id in enumerate(qid.tolist()):
            top = np.zeros(0, x.dtype), np.zeros(0, np.int64)
            for leaf in leaves:
                top = leaf.walk(q[row], own_id, k, top)
            out_q.append(np.full(len(top[0]), own_id))
            out_s.append(top[0].astype(np.int64))
            out_i.append(top[1])
        return np.concatenate(out_q), np.concatenate(out_i), np.concatenate(out_s)

    return searched(whole(queries), whole(vectors), k, find, "long", query_rows, block_rows)
