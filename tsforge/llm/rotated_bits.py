"""Approximate nearest neighbours from randomly rotated one-bit codes.

A unit vector is rotated by a fixed random orthogonal matrix and kept as the signs of its
components, packed to bits, with one correction scalar: the inner product f of the rotated
vector and its normalised sign vector. For a rotated unit query q the estimate of the cosine is
(signs . q / sqrt(d)) / f, with an error below ``epsilon`` * sqrt((1 - f^2) / f^2 / (d - 1)) but
for a small chance. Vectors whose upper bound reaches the kth best cosine found so far are
ranked anew on the original vectors, in double precision; the others are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.llm.common import written
from tsforge.llm.vectors import best_rows, matrix, searched, usable


def rotation(dim: int, seed: int = 29) -> np.ndarray:
    """A random orthogonal matrix, the same for every task."""
    q, r = np.linalg.qr(np.random.default_rng((seed, dim)).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encoded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed sign bits, correction scalars) of the rows of ``x``, none of them zero."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    turned = unit @ rotation(x.shape[1]).T
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(x.shape[1])


def index(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, v, code, factor): every usable, non-zero vector with its code; a written table."""
    rows = usable(vectors).where(F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            dims = table.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = table.filter(pa.array(dims == dim))
                bits, factor = encoded(matrix(part, "v", dim))
                part = part.append_column("code", pa.array([b.tobytes() for b in bits], pa.binary()))
                yield from part.append_column("factor", pa.array(factor)).combine_chunks().to_batches()

    return written(rows.mapInArrow(run, "vec_id long, v array<double>, dim int, code binary, factor double"), "codes")


def nearest(codes: DataFrame, queries: DataFrame, k: int = 5, epsilon: float = 2.5, query_rows: int = 1024, block_rows: int = 8192, leaf_rows: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score double): the k rows of largest cosine found, exact scores.

    ``codes`` comes from :func:`index`; ``queries`` is a part of it. A query's own id is no
    candidate; ties go to the smaller id. Null, zero and non-finite vectors are not in the
    index. All rows are candidates; the error bound alone decides which are ranked anew.
    """

    def find(ask: pa.Table, own: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        dim = ask.column("dim")[0].as_py()
        q, qid = matrix(ask, "v", dim), ask.column("vec_id").to_numpy()
        length = np.linalg.norm(q, axis=1)
        turned = ((q / length[:, None]) @ rotation(dim).T).astype(np.float32)
        best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]  # query row, id, score
        kth = np.full(len(q), -np.inf)
        for start in range(0, own.num_rows, leaf_rows):
            leaf = own.slice(start, leaf_rows)
            x, ids, f = matrix(leaf, "v", dim), leaf.column("vec_id").to_numpy(), leaf.column("factor").to_numpy()
            norms = np.linalg.norm(x, axis=1)
            bits = np.frombuffer(b"".join(leaf.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
            signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
            guess = (turned @ signs.T) / (np.sqrt(dim) * f).astype(np.float32)
            error = (epsilon * np.sqrt(np.maximum(0, 1 - f * f) / (f * f) / max(1, dim - 1))).astype(np.float32)
            guess[qid[:, None] == ids[None, :]] = -np.inf

            def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
                return np.concatenate([(x[b[i : i + 65536]] * q[a[i : i + 65536]]).sum(axis=1) / (norms[b[i : i + 65536]] * length[a[i : i + 65536]]) for i in range(0, len(a), 65536)] or [np.zeros(0)])

            # The likeliest rows first, to know a good kth score before the bounds are used.
            few = min(4 * k, len(ids))
            b = np.argpartition(-guess, few - 1, axis=1)[:, :few].ravel()
            a = np.repeat(np.arange(len(q)), few)
            first = np.where(np.isfinite(guess[a, b]), exact(a, b), -np.inf).reshape(len(q), few)
            if few >= k:
                kth = np.maximum(kth, np.partition(first, few - k, axis=1)[:, few - k])
            a, b = np.nonzero((guess + error >= (kth - 1e-6)[:, None]) & np.isfinite(guess))
            merged = [np.r_[best[0], a], np.r_[best[1], ids[b]], np.r_[best[2], exact(a, b)]]
            keep = best_rows(merged[0], merged[2], merged[1], k)
            best = [m[keep] for m in merged]
            held = np.bincount(best[0], minlength=len(q))
            low = np.full(len(q), np.inf)
            np.minimum.at(low, best[0], best[2])
            kth = np.where(held >= k, np.maximum(kth, low), kth)
        return qid[best[0]], best[1], best[2]

    return searched(queries, codes, k, find, "double", query_rows, block_rows)
