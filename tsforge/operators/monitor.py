"""Drift, control charts, regime changes, latency."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsforge.functions.timeunits import MINUTE, micros
from tsforge.operators.causal import cumulative
from tsforge.operators.layout import Axis, per_key, with_position
from tsforge.operators.quality import one_row
from tsforge.operators.ranks import exact_quantiles
from tsforge.operators.scan import run_states
from tsforge.session import measured


def alert_rate(decisions: DataFrame, ts: str = "ts", side: str = "side", by: list[str] | None = None) -> DataFrame:
    """Share of rows per day that are not WAIT."""
    return decisions.groupBy(*(by or []), F.to_date(ts).alias("date")).agg(
        F.avg((F.col(side) != "WAIT").cast("double")).alias("alert_rate")
    )


def control_chart(df: DataFrame, ts: str, value: str, by: list[str] | None = None) -> DataFrame:
    """(mu, sigma, ucl, lcl, last, out_of_control): mean +- 3 sigma, lower limit at least 0."""
    d = df.groupBy(*(by or [])).agg(
        F.avg(value).alias("mu"), F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("sigma"), F.max_by(value, ts).alias("last")
    )
    d = d.withColumns(
        {"ucl": F.col("mu") + 3 * F.col("sigma"), "lcl": F.greatest(F.lit(0.0), F.col("mu") - 3 * F.col("sigma"))}
    )
    return d.withColumn("out_of_control", (F.col("last") > F.col("ucl")) | (F.col("last") < F.col("lcl")))


def drift_report(features: DataFrame, decisions: DataFrame, flags: list[str], ts: str = "ts", ev: str = "EV") -> DataFrame:
    """(metric, value): imputed shares, class mix, alert-rate chart and mean EV."""

    def long(df: DataFrame, names: list[str]) -> DataFrame:
        items = [F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]
        return df.select(F.explode(F.array(*items)).alias("m")).select("m.*")

    imputed = features.agg(*[F.coalesce(F.avg(F.col(f).cast("double")), F.lit(0.0)).alias(f"impute{f}") for f in flags])
    parts = long(imputed, imputed.columns) if flags else None
    mix = decisions.groupBy("side").agg(F.count(F.lit(1)).alias("n"))
    total = Window.partitionBy(F.lit(1))  # one row per class
    mix = mix.select(F.concat(F.lit("mix_"), "side").alias("metric"), (F.col("n") / F.sum("n").over(total)).alias("value"))
    chart = control_chart(alert_rate(decisions, ts), "date", "alert_rate")
    chart = long(chart, ["mu", "sigma", "ucl", "lcl", "last", "out_of_control"]).withColumn("metric", F.concat(F.lit("alert_"), "metric"))
    mean = long(decisions.agg(F.coalesce(F.avg(ev), F.lit(0.0)).alias("ev_trade")), ["ev_trade"])
    out = mix.unionByName(chart).unionByName(mean)
    return parts.unionByName(out) if parts is not None else out


def standardise(df: DataFrame, axis: Axis, col: str, out: str) -> DataFrame:
    stats = per_key(df, axis.keys, F.avg(col).alias("_mu"), F.stddev_samp(col).alias("_sd"))
    sd = F.when(F.coalesce("_sd", F.lit(0.0)) == 0, 1.0).otherwise(F.col("_sd"))
    return df.join(stats, axis.keys).withColumn(out, (F.col(col) - F.col("_mu")) / sd).drop("_mu", "_sd")


def cusum_threshold(
    df: DataFrame,
    axis: Axis,
    col: str,
    k: float = 0.25,
    boot_n: int = 200,
    q: float = 0.99,
    start: str | None = None,
    end: str | None = None,
    seed: int = 42,
    part_rows: int = 8192,
) -> DataFrame:
    """(key, h): q-quantile of the largest two-sided excursion over resamples of a reference period.

    All rows of [start, end), or of the series, are drawn from; a resample is as long as that
    period. Draws come from a hash of key, resample and place. No window group holds more than
    ``part_rows`` rows: parts of a resample are summed up first and put together by their summaries.
    """
    z = standardise(df.select(*axis.keys, axis.ts, *axis.ties, col), axis, col, "_z")
    for bound, keep in ((start, F.col(axis.ts) >= F.lit(start)), (end, F.col(axis.ts) < F.lit(end))):
        z = z.where(keep) if bound is not None else z
    ref = measured(with_position(z, axis, "_pos").select(*axis.keys, "_pos", F.coalesce("_z", F.lit(0.0)).alias("_z")))
    sizes = per_key(ref, axis.keys, F.count(F.lit(1)).alias("_n"))
    places = ref.select(*axis.keys, "_pos").join(sizes, axis.keys).withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(boot_n - 1))))
    name = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in axis.keys], "_b", F.col("_pos").cast("string"))
    number = F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")
    draws = places.select(*axis.keys, "_b", F.col("_pos").alias("_i"), F.pmod(number, F.col("_n")).alias("_pos")).join(ref, [*axis.keys, "_pos"])
    # Each resample is cut into parts; a part is its sum, its lowest and highest prefix and its best rise and fall.
    one = [*axis.keys, "_b", "_part"]
    path = Window.partitionBy(*one).orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    d = draws.withColumn("_part", F.floor(F.col("_i") / F.lit(part_rows)))
    d = d.withColumns({"_u": F.sum(F.col("_z") - k).over(path), "_v": F.sum(F.col("_z") + k).over(path)})
    d = d.withColumns({"_rise": F.col("_u") - F.min("_u").over(path), "_fall": F.max("_v").over(path) - F.col("_v")})
    parts = d.groupBy(*one).agg(
        F.sum(F.col("_z") - k).alias("_su"), F.sum(F.col("_z") + k).alias("_sv"), F.min("_u").alias("_u0"), F.max("_u").alias("_u1"),
        F.min("_v").alias("_v0"), F.max("_v").alias("_v1"), F.max("_rise").alias("_rise"), F.max("_fall").alias("_fall"),
    )
    # A sum that restarts at zero is the running sum less its lowest value so far, here or in an earlier part.
    ahead = Window.partitionBy(*axis.keys, "_b").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns({"_ou": F.coalesce(F.sum("_su").over(ahead), F.lit(0.0)), "_ov": F.coalesce(F.sum("_sv").over(ahead), F.lit(0.0))})
    low = F.least(F.lit(0.0), F.min(F.col("_ou") + F.col("_u0")).over(ahead))
    high = F.greatest(F.lit(0.0), F.max(F.col("_ov") + F.col("_v1")).over(ahead))
    up = F.greatest(F.col("_rise"), F.col("_ou") + F.col("_u1") - low)
    down = F.greatest(F.col("_fall"), high - F.col("_ov") - F.col("_v0"))
    top = parts.withColumn("_top", F.greatest(up, down)).groupBy(*axis.keys, "_b").agg(F.max("_top").alias("_top"))
    return top.groupBy(*axis.keys).agg(F.percentile("_top", q).alias("h"))


CUSUM_START = {"up": 0.0, "down": 0.0}


def cusum_step(state: dict, z: float, k: float, h: float) -> tuple[bool, dict]:
    """Advance both sums by one value; an excursion past h is a change and resets them."""
    up = max(0.0, state["up"] + z - k)
    down = min(0.0, state["down"] + z + k)
    if up > h or -down > h:
        return True, {"up": 0.0, "down": 0.0}
    return False, {"up": up, "down": down}


def cusum_regimes(df: DataFrame, axis: Axis, col: str, thresholds: DataFrame, k: float = 0.25) -> DataFrame:
    """(key, ts, changed, regime_id): regime changes of the standardised series."""
    z = standardise(df.select(*axis.keys, axis.ts, *axis.ties, col), axis, col, "_z")
    z = z.join(measured(thresholds.select(*axis.keys, F.col("h").alias("_h"))), axis.keys)

    def runner(pdf: pd.DataFrame, state: dict) -> tuple[pd.DataFrame, dict]:
        h, flags = float(pdf["_h"].iloc[0]), []
        for v in pdf["_z"].fillna(0.0).tolist():
            changed, state = cusum_step(state, v, k, h)
            flags.append(int(changed))
        return pd.DataFrame({"changed": flags}), state

    d = run_states(z, axis, runner, CUSUM_START, {"changed": "int"})
    d = cumulative(d.select(*axis.keys, axis.ts, *axis.ties, "changed"), axis, {"changed": "regime_id"})
    return d.withColumn("regime_id", F.col("regime_id").cast("long"))


def retrain_trigger(chart: DataFrame, regimes: DataFrame, axis: Axis, last: int = 10) -> DataFrame:
    """One row (reason) when a regime changed in the last rows or the chart is out of control, else none."""
    from tsforge.operators.causal import tail_per_key

    recent = tail_per_key(regimes, axis, last).agg(F.coalesce(F.max("changed"), F.lit(0)).alias("changed"))
    state = chart.agg(F.coalesce(F.max(F.col("out_of_control").cast("int")), F.lit(0)).alias("ooc"))
    d = one_row(recent, state).where("changed = 1 OR ooc = 1")
    return d.select(F.when(F.col("changed") == 1, "regime_shift").otherwise("alert_rate_ooc").alias("reason"))


# Stage time fields of an event and their budgets in milliseconds.
STAGE_BUDGETS = [("feat", "t_feat_ms", 20.0), ("nn", "t_nn_ms", 30.0), ("policy", "t_policy_ms", 10.0)]
STAGE_FIELDS = ["t_feat_ms", "t_nn_ms", "t_policy_ms", "t_total_ms"]
HORIZONS = {"all": None, "1m": MINUTE, "5m": 5 * MINUTE, "10m": 10 * MINUTE}


def latency_report(
    events: DataFrame, ts: str = "ts", cols: list[str] | None = None, now: Column | None = None, horizons: dict[str, int | None] | None = None
) -> DataFrame:
    """(horizon, metric, p50, p99, n): exact percentiles over all events and over recent horizons."""
    cols = cols or STAGE_FIELDS
    horizons = horizons or HORIZONS
    now_us = micros(now if now is not None else F.current_timestamp())
    us = micros(ts)
    wanted = F.filter(
        F.array(*[F.when(F.lit(True) if h is None else us >= now_us - F.lit(h), F.lit(name)) for name, h in horizons.items()]),
        lambda x: x.isNotNull(),
    )
    items = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v")) for c in cols])
    long = events.select(F.explode(wanted).alias("horizon"), items.alias("_m"))
    long = long.select("horizon", F.explode("_m").alias("m")).select("horizon", "m.metric", "m.v").where("v IS NOT NULL")
    qs = exact_quantiles(long, ["horizon", "metric"], "v", [0.5, 0.99])
    p = qs.groupBy("horizon", "metric").pivot("prob", [0.5, 0.99]).agg(F.max("quantile"))
    p = p.select("horizon", "metric", F.col("`0.5`").alias("p50"), F.col("`0.99`").alias("p99"))
    return p.join(long.groupBy("horizon", "metric").agg(F.count(F.lit(1)).alias("n")), ["horizon", "metric"])


def sla_flags(events: DataFrame) -> DataFrame:
    """degraded, exceed_stage (the last stage over budget) and delta_min since the bar closed, where known."""
    over = [F.coalesce(F.col(c) > b, F.lit(False)) for _, c, b in STAGE_BUDGETS]
    stage = F.lit(None).cast("string")
    for (name, _, _), hit in zip(STAGE_BUDGETS, over):
        stage = F.when(hit, name).otherwise(stage)
    d = events.withColumns({"degraded": over[0] | over[1] | over[2], "exceed_stage": stage})
    if "candle_close_ts" in events.columns:
        d = d.withColumn("delta_min", (micros("ts") - micros("candle_close_ts")) / F.lit(float(MINUTE)))
    return d


def table_mse(a: DataFrame, b: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Mean squared error between two tables of equal layout (parity check)."""
    right = b.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in cols])
    errs = [F.pow(F.col(c) - F.col(f"_b_{c}"), F.lit(2.0)) for c in cols]
    total = errs[0]
    for e in errs[1:]:
        total = total + e
    return a.select(*keys, *cols).join(right, keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(total / F.lit(float(len(cols)))).alias("mse")
    )
