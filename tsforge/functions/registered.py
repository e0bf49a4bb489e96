"""Functions for SQL users: a grid table function, an array function and an aggregate."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf, udtf


@udtf(returnType="us bigint")
class GridRows:
    """grid_rows(lo, hi, step): every multiple of step from lo to hi, as rows."""

    def eval(self, lo: int, hi: int, step: int) -> Iterator[tuple[int]]:
        for us in range(lo, hi + 1, step):
            yield (us,)


@pandas_udf("array<double>")
def softmax_array(z: pd.Series, temperature: pd.Series) -> pd.Series:
    """Max-shifted softmax with temperature, all rows of an Arrow batch at once; null and empty arrays stay."""
    sizes = np.array([0 if v is None else len(v) for v in z])
    full = np.flatnonzero(sizes)
    if not len(full):
        return z
    start = np.cumsum(sizes[full]) - sizes[full]
    flat = np.concatenate([np.asarray(z.iloc[i], dtype=float) for i in full])
    flat = flat - np.repeat(np.maximum.reduceat(flat, start), sizes[full])
    flat = np.exp(flat / np.repeat(np.maximum(temperature.to_numpy(dtype=float)[full], 1e-6), sizes[full]))
    flat = flat / np.repeat(np.add.reduceat(flat, start), sizes[full])
    out = z.astype(object).copy()
    for i, part in zip(full.tolist(), np.split(flat, start[1:])):
        out.iloc[i] = part
    return out


@pandas_udf("double")
def ece_of_bins(hits: pd.Series, confidence: pd.Series, n: pd.Series) -> float:
    """Aggregate: expected calibration error of a group from the sums of its bins, one row a bin."""
    total = float(n.sum())
    return float((hits - confidence).abs().sum() / total) if total else 0.0


def register(spark: SparkSession) -> None:
    """Make grid_rows, softmax_array and the aggregate ece_of_bins callable from ``spark.sql``."""
    spark.udtf.register("grid_rows", GridRows)
    spark.udf.register("softmax_array", softmax_array)
    spark.udf.register("ece_of_bins", ece_of_bins)
