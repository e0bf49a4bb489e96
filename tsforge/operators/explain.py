"""Attributions and explanation documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.functions.scalars import attr_summary, topk_attr
from tsforge.functions.timeunits import DAY, micros
from tsforge.session import cut_lineage

Scorer = Callable[[np.ndarray], np.ndarray]


def feature_means(df: DataFrame, vec: str, n_features: int) -> DataFrame:
    """One row (means array<double>) of the per-feature mean over all windows and steps."""
    cells = df.select(F.posexplode(vec).alias("i", "v")).groupBy(F.pmod("i", F.lit(n_features)).alias("f")).agg(
        F.avg(F.col("v").cast("double")).alias("m")
    )
    ordered = F.array_sort(F.collect_list(F.struct("f", "m")))  # one entry per feature
    return cells.agg(F.transform(ordered, lambda s: s["m"]).alias("means"))


def path_attr(df: DataFrame, vec: str, coef: list[float], n_features: int, baseline: str = "zeros", out: str = "attr") -> DataFrame:
    """Integrated gradients of a linear score: (x - baseline) * coefficient, exact for any path.

    ``vec`` is a flattened [W, F] window; the baseline is zero or the feature means.
    """
    weights = F.array(*[F.lit(float(c)) for c in coef])
    if baseline == "zeros":
        return df.withColumn(out, F.zip_with(vec, weights, lambda x, c: x.cast("double") * c))
    means = F.array(*[F.lit(m) for m in feature_means(df, vec, n_features).first()["means"]])  # one number per feature
    shifted = F.transform(vec, lambda x, i: x.cast("double") - F.get(means, F.pmod(i, F.lit(n_features)).cast("int")))
    return df.withColumn(out, F.zip_with(shifted, weights, lambda x, c: x * c))


def score_with(df: DataFrame, vec: str, predict: Scorer, shape: tuple[int, int], names: tuple[str, ...] = ("p_wait", "p_long", "p_short")) -> DataFrame:
    """Append class probabilities from a user function [N, W, F] -> [N, 3], one Arrow batch at a time."""
    schema = T.StructType(list(df.schema.fields))
    for n in names:
        schema = schema.add(n, "double")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = np.stack([np.asarray(v, dtype=float).reshape(shape) for v in pdf[vec]])
                p = np.asarray(predict(x), dtype=float)
                yield pdf.assign(**{n: p[:, i] for i, n in enumerate(names)})

    return df.mapInPandas(run, schema)


def perturbation_attr(df: DataFrame, vec: str, scorer: Scorer, baseline: list[float], k: int = 10, names: list[str] | None = None, out: str = "shap") -> DataFrame:
    """The k features whose replacement by their background mean changes the score most.

    Appends array<struct<f, shap>>; ``scorer`` maps [N, F] to N scores.
    """
    base = np.asarray(baseline, dtype=float)
    labels = names or [f"f{i}" for i in range(len(base))]
    schema = T.StructType(list(df.schema.fields)).add("_delta", T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack([np.asarray(v, dtype=float) for v in pdf[vec]])
            ref = np.asarray(scorer(x), dtype=float)
            delta = np.empty_like(x)
            for j in range(x.shape[1]):
                moved = x.copy()
                moved[:, j] = base[j]
                delta[:, j] = ref - np.asarray(scorer(moved), dtype=float)
            yield pdf.assign(_delta=list(delta))

    d = df.mapInPandas(run, schema)
    items = topk_attr("_delta", len(base), k, labels)
    return d.withColumn(out, F.transform(items, lambda s: F.struct(s["f"].alias("f"), s["attr"].alias("shap")))).drop("_delta")


def documents(df: DataFrame, id_col: Column | str, ts: Column | str, attr: str, W: int, n_features: int, k: int = 10, names: list[str] | None = None) -> DataFrame:
    """Explanation documents (id, ts_unix, window_shape, features, topk, summary)."""
    names = names or [f"f{i}" for i in range(n_features)]
    us = micros(ts)
    return df.select(
        (F.col(id_col) if isinstance(id_col, str) else id_col).alias("id"),
        F.floor(us / F.lit(1_000_000)).cast("long").alias("ts_unix"),
        F.array(F.lit(W), F.lit(n_features)).alias("window_shape"),
        F.array(*[F.lit(n) for n in names]).alias("features"),
        topk_attr(attr, n_features, k, names).alias("topk"),
        attr_summary(attr).alias("summary"),
    )


def live_documents(df: DataFrame, now_unix: Column | int, ttl_days: int = 30) -> DataFrame:
    """Documents not older than the time to live."""
    now = now_unix if isinstance(now_unix, Column) else F.lit(now_unix)
    return df.where(now - F.col("ts_unix") <= F.lit(ttl_days * DAY // 1_000_000))


def collect_garbage(spark: SparkSession, path: str, now_unix: int, ttl_days: int = 30) -> int:
    """Rewrite a document table without expired rows; returns how many went."""
    docs = spark.read.parquet(path)
    keep = cut_lineage(live_documents(docs, now_unix, ttl_days))
    removed = docs.count() - keep.count()
    if removed:
        keep.write.mode("overwrite").parquet(path)
    return removed


def alerts_only(df: DataFrame, alerts: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose id is flagged in the alert table."""
    return df.join(alerts.where("alert = 1").select(key), key, "left_semi")
