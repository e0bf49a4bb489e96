"""A stated query set against all vectors, in a grid of bounded blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>) of the rows with an id and a non-empty vector of finite numbers."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & (F.size("v") > 0) & ~bad)


def matrix(table: pa.Table, name: str, width: int) -> np.ndarray:
    """A list column as rows of ``width`` numbers."""
    return table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def searched(
    queries: DataFrame,
    candidates: DataFrame,
    k: int,
    find: Callable[[pa.Table, pa.Table], tuple[np.ndarray, np.ndarray, np.ndarray]],
    score_type: str,
    query_rows: int,
    block_rows: int,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all candidates for each query.

    Both tables have vec_id, dim and the same further columns. Queries and candidates are dealt
    by a hash of their id to blocks of about ``query_rows`` and ``block_rows``; every pair of
    blocks is a group in which ``find`` gives each query's k best. A group holds a bounded
    number of rows and passes on k rows per query. Only vectors of one length meet.
    """
    # The counts only say how many blocks there are.
    left = queries.count() // query_rows + 1
    right = candidates.count() // block_rows + 1
    slot = lambda n, salt: F.pmod(F.xxhash64(F.col("vec_id"), F.lit(salt)), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    q = queries.withColumns({"_asks": F.lit(True), "_q": slot(left, 1)}).withColumn("_c", every(right))
    c = candidates.withColumns({"_asks": F.lit(False), "_c": slot(right, 2)}).withColumn("_q", every(left))

    def group(table: pa.Table) -> pa.Table:
        asks = table.column("_asks")
        ask, own = table.filter(asks), table.filter(pa.compute.invert(asks))
        a, b, s = find(ask, own) if ask.num_rows and own.num_rows else (np.zeros(0, np.int64),) * 3
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(s).cast(pa.int64() if score_type == "long" else pa.float64())})

    found = q.unionByName(c).groupBy("_q", "_c", "dim").applyInArrow(group, f"query_id long, vec_id long, score {score_type}")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def best_rows(query: np.ndarray, score: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best rows of each query: highest score, then smallest id."""
    order = np.lexsort((vec_id, -score, query))
    q = query[order]
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
    place = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
    return order[place < k]
