"""Profiles, key checks and gates. A gate is a table (check, value, threshold, passed)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsforge.functions.timeunits import micros
from tsforge.operators.layout import Axis


def table_summary(df: DataFrame, ts: str = "ts") -> DataFrame:
    """One row: number of rows, first and last time."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def class_mix(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """Counts and shares of each value (of ``by`` groups)."""
    by = by or []
    counts = df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy(*(by or [F.lit(1)]))  # one row per class
    return counts.withColumn("share", F.col("n") / F.sum("n").over(group))


def one_row(*summaries: DataFrame) -> DataFrame:
    """Put several one-row summaries side by side: a union and one aggregation."""
    stacked = summaries[0]
    for s in summaries[1:]:
        stacked = stacked.unionByName(s, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Return ``df``; raise with up to five examples when a key repeats."""
    bad = duplicate_keys(df, keys).orderBy(*keys).limit(5).collect()
    if bad:
        raise ValueError(f"duplicate keys, for example {[r.asDict() for r in bad]}")
    return df


def key_counts(df: DataFrame, keys: list[str]) -> Column:
    """Number of surplus rows per key combination (to use inside ``agg``)."""
    return F.count(F.lit(1)) - F.count_distinct(*[F.col(k) for k in keys])


def profile(df: DataFrame, cols: list[str], impute_flags: dict[str, str] | None = None) -> DataFrame:
    """(name, dtype, nan_ratio, imputed_ratio, min, max) for all columns in one scan."""
    flags = impute_flags or {}
    aggs, rows = [F.count(F.lit(1)).alias("_n")], []
    kinds = dict(df.dtypes)
    for i, c in enumerate(cols):
        flag = F.avg(F.coalesce(F.col(flags[c]).cast("double"), F.lit(0.0))) if c in flags else F.lit(0.0)
        aggs += [
            F.count_if(F.col(c).isNull()).alias(f"_null{i}"),
            F.max(F.lit(0.0)).alias(f"_imp{i}") if c not in flags else flag.alias(f"_imp{i}"),
            F.min(F.col(c).cast("double")).alias(f"_min{i}"),
            F.max(F.col(c).cast("double")).alias(f"_max{i}"),
        ]
        rows.append(
            F.struct(
                F.lit(c).alias("name"),
                F.lit(kinds[c]).alias("dtype"),
                F.try_divide(F.col(f"_null{i}"), F.col("_n")).alias("nan_ratio"),
                F.col(f"_imp{i}").alias("imputed_ratio"),
                F.col(f"_min{i}").alias("min"),
                F.col(f"_max{i}").alias("max"),
            )
        )
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def coverage(df: DataFrame, axis: Axis, every: int, horizon_us: int | None = None) -> DataFrame:
    """Per key: expected and present bars of the last ``horizon_us``, gap ratio, surplus rows."""
    us = micros(axis.ts)
    span = df.groupBy(*axis.keys).agg(F.min(us).alias("_lo"), F.max(us).alias("_hi"))
    rows = df.select(*axis.keys, us.alias("_us"))
    if horizon_us is not None:
        span = span.withColumn("_lo", F.col("_hi") - F.lit(horizon_us))
        rows = rows.join(span, axis.keys).where(F.col("_us") >= F.col("_lo"))
    # Distinct times come from a pre-aggregation on (key, time): even for a hot key.
    seen = rows.groupBy(*axis.keys, "_us").agg(F.count(F.lit(1)).alias("_c"))
    seen = seen.groupBy(*axis.keys).agg(F.count(F.lit(1)).alias("present_bars"), F.sum(F.col("_c") - 1).alias("dup_key_count"))
    d = span.join(seen, axis.keys).withColumn("expected_bars", F.floor((F.col("_hi") - F.col("_lo")) / F.lit(every)) + 1)
    d = d.withColumn("gap_ratio", 1.0 - F.col("present_bars") / F.col("expected_bars"))
    return d.select(*axis.keys, "expected_bars", "present_bars", "gap_ratio", "dup_key_count")


def gate(df: DataFrame, checks: dict[str, tuple[str, str, float]], by: list[str] | None = None) -> DataFrame:
    """Turn columns of a report into gate rows: {check: (column, '<=' | '>=' | '==' | '>', limit)}."""
    ops = {"<=": lambda c, v: c <= v, ">=": lambda c, v: c >= v, "==": lambda c, v: c == v, ">": lambda c, v: c > v}
    rows = [
        F.struct(
            F.lit(name).alias("check"),
            F.col(col).cast("double").alias("value"),
            F.lit(float(limit)).alias("threshold"),
            F.coalesce(ops[op](F.col(col).cast("double"), F.lit(float(limit))), F.lit(False)).alias("passed"),
        )
        for name, (col, op, limit) in checks.items()
    ]
    return df.select(*(by or []), F.explode(F.array(*rows)).alias("g")).select(*(by or []), "g.*")


def require(checks: DataFrame) -> DataFrame:
    """Raise when any gate row did not pass; list at most twenty."""
    bad = checks.where(~F.col("passed")).limit(20).collect()
    if bad:
        raise ValueError(f"gate failed: {[r.asDict() for r in bad]}")
    return checks


def bar_qa(
    df: DataFrame,
    axis: Axis,
    every: int,
    cols: list[str],
    impute_flags: dict[str, str] | None = None,
    horizon_us: int | None = None,
    gap_max: float = 0.005,
    impute_max: float = 0.05,
) -> DataFrame:
    """Bar table gate per key: gaps, nulls, imputed share, surplus rows."""
    flags = impute_flags or {}
    cover = coverage(df, axis, every, horizon_us)
    rows = df
    if horizon_us is not None:
        last = df.groupBy(*axis.keys).agg(F.max(micros(axis.ts)).alias("_hi"))
        rows = df.join(last, axis.keys).where(micros(axis.ts) >= F.col("_hi") - F.lit(horizon_us))
    null_share = [F.avg(F.col(c).isNull().cast("double")) for c in cols]
    imputed = [F.avg(F.coalesce(F.col(f).cast("double"), F.lit(0.0))) for f in flags.values()]
    stats = rows.groupBy(*axis.keys).agg(
        (F.greatest(*null_share) if len(null_share) > 1 else null_share[0]).alias("null_ratio"),
        (F.greatest(*imputed) if len(imputed) > 1 else imputed[0] if imputed else F.max(F.lit(0.0))).alias("imputed_ratio"),
    )
    report = cover.join(stats, axis.keys)
    return gate(
        report,
        {
            "gap_ratio": ("gap_ratio", "<=", gap_max),
            "null_ratio": ("null_ratio", "<=", 0.0),
            "imputed_ratio": ("imputed_ratio", "<=", impute_max),
            "dup_key_count": ("dup_key_count", "<=", 0.0),
        },
        axis.keys,
    )


def feature_qa(
    df: DataFrame,
    axis: Axis,
    every: int,
    n_min: int = 10,
    n_max: int = 20,
    gap_max: float = 0.005,
    impute_max: float = 0.05,
    ms_per_bar: float | None = None,
    ms_max: float = 50.0,
    horizon_us: int | None = None,
    warmup_us: int = 0,
) -> DataFrame:
    """Feature table gate: number of features, nulls, imputed share, gaps, build time.

    With ``horizon_us`` only the usable part of the horizon, less ``warmup_us``, must be covered.
    """
    from tsforge.functions.scalars import numeric_columns

    numeric = numeric_columns(df, (*axis.keys, axis.ts, "label"))
    feats = [c for c in numeric if not c.startswith("_imputed")]
    flags = [c for c in numeric if c.startswith("_imputed")]
    null = reduce(lambda a, b: F.greatest(a, b), [F.avg(F.col(c).isNull().cast("double")) for c in feats])
    imputed = reduce(lambda a, b: F.greatest(a, b), [F.avg(F.col(c).cast("double")) for c in flags] or [F.max(F.lit(0.0))])
    usable = None if horizon_us is None else horizon_us - warmup_us
    cover = coverage(df, axis, every, usable).agg(F.max("gap_ratio").alias("gap_ratio"), F.sum("dup_key_count").alias("dups"))
    stats = df.agg(null.alias("null_ratio"), imputed.alias("imputed_ratio"))
    report = one_row(stats, cover).withColumn("n", F.lit(len(feats)))
    checks = {
        "n_features_min": ("n", ">=", n_min),
        "n_features_max": ("n", "<=", n_max),
        "null_ratio": ("null_ratio", "<=", 0.0),
        "imputed_ratio": ("imputed_ratio", "<=", impute_max),
        "gap_ratio": ("gap_ratio", "<=", gap_max),
        "dup_key_count": ("dups", "<=", 0.0),
    }
    if ms_per_bar is not None:
        report = report.withColumn("ms", F.lit(float(ms_per_bar)))
        checks["ms_per_bar"] = ("ms", "<=", ms_max)
    return gate(report, checks)


def label_qa(labels: DataFrame, features: DataFrame, keys: list[str], wait_max: float = 0.8) -> DataFrame:
    """Label table gate: nulls, allowed values, surplus keys, rows without features, WAIT share."""
    need = ["label", "tp_px", "sl_px", "timeout_ts"]
    nulls = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in need if c in labels.columns])
    stats = labels.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(nulls).alias("nulls"),
        F.count_if(~F.col("label").isin("LONG", "SHORT", "WAIT")).alias("odd"),
        F.avg((F.col("label") == "WAIT").cast("double")).alias("wait_share"),
    )
    dups = duplicate_keys(labels, keys).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("dups"))
    lost = labels.select(*keys).join(features.select(*keys), keys, "left_anti").agg(F.count(F.lit(1)).alias("lost"))
    report = one_row(stats, dups, lost)
    return gate(
        report,
        {
            "rows": ("n", ">", 0),
            "nulls": ("nulls", "<=", 0),
            "outside_allowed_set": ("odd", "<=", 0),
            "dup_key_count": ("dups", "<=", 0),
            "labels_without_features": ("lost", "<=", 0),
            "wait_share": ("wait_share", "<=", wait_max),
        },
    )


def check_probs(df: DataFrame, cols: list[str], atol: float = 1e-6) -> DataFrame:
    """Probabilities: finite, inside [0, 1], summing to 1."""
    p = [F.col(c).cast("double") for c in cols]
    bad_number = reduce(lambda a, b: a | b, [c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")) for c in p])
    outside = reduce(lambda a, b: a | b, [(c < -1e-9) | (c > 1 + 1e-9) for c in p])
    total = reduce(lambda a, b: a + b, p)
    report = df.agg(
        F.count_if(bad_number).alias("a"), F.count_if(outside).alias("b"), F.count_if(F.abs(total - 1.0) > atol).alias("c")
    )
    return gate(report, {"not_finite": ("a", "<=", 0), "out_of_range": ("b", "<=", 0), "sum_not_one": ("c", "<=", 0)})


def set_checks(train: DataFrame, mask: DataFrame, held_out: DataFrame, keys: list[str]) -> DataFrame:
    """Train keys all inside the mask, and no masked key in the held-out rows."""
    kept = mask.where(F.col("keep") == 1).select(*keys)
    outside = train.select(*keys).join(kept, keys, "left_anti").agg(F.count(F.lit(1)).alias("a"))
    leaked = kept.join(held_out.select(*keys), keys, "left_semi").agg(F.count(F.lit(1)).alias("b"))
    return gate(
        one_row(outside, leaked), {"train_outside_mask": ("a", "<=", 0), "mask_in_held_out": ("b", "<=", 0)}
    )


def join_integrity(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` and how many find a partner (join count = left count when sound)."""
    n = left.agg(F.count(F.lit(1)).alias("n"))
    m = left.select(*keys).join(right.select(*keys), keys).agg(F.count(F.lit(1)).alias("joined"))
    return one_row(n, m).withColumn("ok", F.col("n") == F.col("joined"))


def fold_class_mix(df: DataFrame, fold: str = "fold_id", label: str = "label") -> DataFrame:
    """Class counts per fold as columns, with the WAIT share."""
    d = df.groupBy(fold).pivot(label, ["LONG", "SHORT", "WAIT"]).agg(F.count(F.lit(1))).fillna(0)
    return d.withColumn("wait_share", F.col("WAIT") / (F.col("LONG") + F.col("SHORT") + F.col("WAIT")))


def class_mix_gate(df: DataFrame, wait_max: float = 0.60, fold: str = "fold_id", label: str = "label") -> DataFrame:
    """Gate on the WAIT share of every fold."""
    return gate(fold_class_mix(df, fold, label), {"wait_share": ("wait_share", "<=", wait_max)}, [fold])


def training_gate(
    logs: DataFrame, fold: str, order: str, loss: str, decay: str, gain_min: float = 0.05, decay_min: float = 0.95, decay_max: float = 1.0
) -> DataFrame:
    """Gate per fold on training logs: best against first validation loss, and the decay factor."""
    d = logs.groupBy(fold).agg(F.min_by(loss, order).alias("_first"), F.min(loss).alias("_best"), F.max(decay).alias("_decay"))
    d = d.withColumn("_gain", (F.col("_first") - F.col("_best")) / F.greatest(F.col("_first"), F.lit(1e-9)))
    checks = {
        "loss_improvement": ("_gain", ">=", gain_min),
        "decay_low": ("_decay", ">=", decay_min),
        "decay_high": ("_decay", "<=", decay_max),
    }
    return gate(d, checks, [fold])


def parity_gate(errors: DataFrame, mse_max: float = 1e-3) -> DataFrame:
    """Gate on the mean squared error between two score tables."""
    return gate(errors, {"rows": ("n", ">", 0), "mse": ("mse", "<=", mse_max)})


def new_values(df: DataFrame, col: str, allowed: list[str]) -> DataFrame:
    """Distinct values outside the allowed set."""
    return df.select(col).where(F.col(col).isNotNull() & ~F.col(col).isin(*allowed)).distinct()
