"""Bars, grids and gap filling on a regular time grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsforge.functions.timeunits import DAY, ceil_to, floor_to, from_micros, micros
from tsforge.operators.layout import Axis, over_frames, per_key
from tsforge.session import measured


def _order(axis: Axis) -> Column:
    """What first and last go by. A plain number keeps the aggregation a hash aggregation;
    only tie columns, where times repeat, need a struct (and a sort)."""
    return F.struct("_us", *axis.ties) if axis.ties else F.col("_us")


def _in_bars(df: DataFrame, axis: Axis, every: int) -> DataFrame:
    us = micros(axis.ts)
    return df.where(F.col(axis.ts).isNotNull()).withColumn("_us", us).withColumn("_bar", ceil_to(us, every))


def resample_ohlcv(
    df: DataFrame,
    axis: Axis,
    every: int,
    price: str | None = None,
    volume: str | None = "volume",
    drop_day_anchor: bool = True,
) -> DataFrame:
    """Right-closed, right-labelled OHLCV bars of (b - every, b].

    Give ``price`` for ticks, or leave it out when the input has open/high/low/close.
    first/last are min_by/max_by, so the aggregation is partial on the map side and a hot
    bucket costs one row per map task.
    """
    src = dict.fromkeys(("open", "high", "low", "close"), price) if price else {c: c for c in ("open", "high", "low", "close")}
    rows = _in_bars(df, axis, every)
    at = _order(axis)

    def first(c: str) -> Column:
        return F.min_by(c, F.when(F.col(c).isNotNull(), at))

    def last(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), at))

    aggs = [
        first(src["open"]).alias("open"),
        F.max(src["high"]).alias("high"),
        F.min(src["low"]).alias("low"),
        last(src["close"]).alias("close"),
    ]
    if volume:
        aggs.append(F.coalesce(F.sum(volume), F.lit(0)).cast("double").alias("volume"))
    bars = rows.groupBy(*axis.keys, "_bar").agg(*aggs, F.min("_us").alias("_first"))
    if drop_day_anchor:
        # The bars are written once; the first tick of a series is then found from them, not from the ticks.
        bars = measured(bars)
        first = per_key(bars, axis.keys, F.min("_first").alias("_f"))
        bars = bars.join(first, axis.keys).where(F.col("_bar") > floor_to(F.col("_f"), DAY)).drop("_f")
    bars = bars.drop("_first").dropna(subset=["open", "high", "low", "close"])
    return bars.withColumn(axis.ts, from_micros("_bar")).drop("_bar")


def resample_sum(df: DataFrame, axis: Axis, every: int, cols: list[str], drop_day_anchor: bool = True) -> DataFrame:
    """Bucket sums on the full grid between the first and last bucket; empty buckets are 0."""
    bars = _in_bars(df, axis, every).groupBy(*axis.keys, "_bar").agg(
        *[F.sum(c).cast("double").alias(c) for c in cols], F.min("_us").alias("_first")
    )
    grid = _grid_of(bars, axis, every)
    out = grid.join(bars.drop("_first"), [*axis.keys, "_bar"], "left").fillna(0.0, subset=cols)
    if drop_day_anchor:
        out = out.where(F.col("_bar") > floor_to(F.col("_f"), DAY))
    return out.withColumn(axis.ts, from_micros("_bar")).select(*axis.keys, axis.ts, *cols)


def resample_last(df: DataFrame, axis: Axis, every: int, cols: list[str]) -> DataFrame:
    """Last non-null value of each column per bucket."""
    at = _order(axis)
    out = _in_bars(df, axis, every).groupBy(*axis.keys, "_bar").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in cols]
    )
    return out.withColumn(axis.ts, from_micros("_bar")).select(*axis.keys, axis.ts, *cols)


def _grid_of(bars: DataFrame, axis: Axis, every: int) -> DataFrame:
    """Every bucket label from the first to the last bar of each key.

    The range is exploded in two steps, days and then bars of a day, so no row ever
    carries more than a day of labels and the second step runs in parallel for a long key.
    """
    span = per_key(
        bars.select(*axis.keys, "_bar", "_first"),
        axis.keys,
        F.min("_bar").alias("_lo"),
        F.max("_bar").alias("_hi"),
        F.min("_first").alias("_f"),
    )
    return _explode_range(span, every)


def _explode_range(span: DataFrame, every: int, block: int = 1024) -> DataFrame:
    step = every * block
    blocks = span.withColumn("_b", F.explode(F.sequence("_lo", "_hi", F.lit(step)))).repartition("_lo", "_b")
    return blocks.withColumn(
        "_bar", F.explode(F.sequence(F.col("_b"), F.least(F.col("_b") + F.lit(step - every), F.col("_hi")), F.lit(every)))
    ).drop("_b", "_lo", "_hi")


def time_grid(df: DataFrame, axis: Axis, every: int, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Expected bar times per key: from ``start`` (or the first bar) to ``end`` (or the last)."""
    us = micros(axis.ts)
    span = per_key(df.where(us.isNotNull()), axis.keys, F.min(us).alias("_lo"), F.max(us).alias("_hi"))
    span = span.withColumn("_lo", ceil_to(micros(start) if start is not None else F.col("_lo"), every))
    span = span.withColumn("_hi", floor_to(micros(end) if end is not None else F.col("_hi"), every))
    grid = _explode_range(span.where(F.col("_lo") <= F.col("_hi")), every)
    return grid.withColumn(axis.ts, from_micros("_bar")).select(*axis.keys, axis.ts)


def missing_ts(df: DataFrame, axis: Axis, every: int, n: int | None = 10, grid: DataFrame | None = None) -> DataFrame:
    """Expected bars that are absent, in order; the first ``n`` of all, or all when None."""
    grid = grid if grid is not None else time_grid(df, axis, every)
    seen = df.select(*axis.keys, F.col(axis.ts).cast("timestamp").alias(axis.ts))
    gone = grid.join(seen, [*axis.keys, axis.ts], "left_anti")
    return gone if n is None else gone.orderBy(*axis.keys, axis.ts).limit(n)


def ffill_limit(
    df: DataFrame, axis: Axis, cols: list[str], limit: int = 3, every: int | None = None, flag: str = "{}_imputed"
) -> DataFrame:
    """Carry the last value forward over at most ``limit`` rows and flag filled rows.

    With ``every`` the series is first put on its full grid, otherwise rows are as given.
    """
    if every is not None:
        bars = _in_bars(df, axis, every).groupBy(*axis.keys, "_bar").agg(
            *[F.max_by(c, F.when(F.col(c).isNotNull(), _order(axis))).alias(c) for c in cols],
            F.min("_us").alias("_first"),
        )
        df = _grid_of(bars, axis, every).join(bars.drop("_first"), [*axis.keys, "_bar"], "left")
        df = df.withColumn(axis.ts, from_micros("_bar")).select(*axis.keys, axis.ts, *cols)
        axis = axis.with_(ties=())

    def build(d: DataFrame, w) -> DataFrame:
        frame = w.rowsBetween(-limit, 0)
        for c in cols:
            filled = F.last(c, ignorenulls=True).over(frame)
            d = d.withColumn("_filled", filled)
            d = d.withColumn(flag.format(c), F.col(c).isNull() & F.col("_filled").isNotNull())
            d = d.withColumn(c, F.col("_filled")).drop("_filled")
        return d

    return over_frames(df, axis, build, back=limit)


def align_up(ts: Column | str, every: int) -> Column:
    """The end of the bar a moment belongs to: floor to the grid plus one bar."""
    return from_micros(floor_to(micros(ts), every) + F.lit(every))


def join_measures(base: DataFrame, pieces: list[DataFrame], on: list[str], how: str = "left") -> DataFrame:
    """Chain of joins on the bar key.

    All sides are hash-partitioned on the same columns, so the chain needs one exchange
    per side. (key, bar) is unique per piece, which keeps every join one-to-one.
    """
    out = base
    for piece in pieces:
        out = out.join(piece, on, how)
    return out


def combine_measures(pieces: list[DataFrame], on: list[str]) -> DataFrame:
    """Full outer combination of measures as one union and one aggregation (one shuffle)."""
    stacked = pieces[0]
    for piece in pieces[1:]:
        stacked = stacked.unionByName(piece, allowMissingColumns=True)
    measures = [c for c in stacked.columns if c not in on]
    return stacked.groupBy(*on).agg(*[F.max(c).alias(c) for c in measures])


def first_source(sources: list[DataFrame], keys: list[str]) -> DataFrame:
    """Per key, the rows of the first source in the list that has any (source fallback)."""
    ranked = None
    for rank, src in enumerate(sources):
        part = src.withColumn("_rank", F.lit(rank))
        ranked = part if ranked is None else ranked.unionByName(part, allowMissingColumns=True)
    best = per_key(ranked.select(*keys, "_rank"), keys, F.min("_rank").alias("_best"))
    return ranked.join(best, keys).where(F.col("_rank") == F.col("_best")).drop("_rank", "_best")


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the one with the greatest order columns (partial aggregation)."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return picked.select(*keys, "_r.*")


