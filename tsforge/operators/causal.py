"""Past-only statistics of a series: every frame runs inside bounded chunks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsforge.functions.scalars import finite, safe_log_ratio
from tsforge.functions.timeunits import DAY
from tsforge.operators.layout import Axis, chunk_window, chunked, over_frames, over_pandas, owned
from tsforge.operators.touch import OrderStatistics

STD_FLOOR = 1e-12
SQL_FRAME_LIMIT = 64


def winsor_values(x: pd.Series, window: int, low: float = 0.01, high: float = 0.99) -> pd.Series:
    """Clip each value to the interpolated quantiles of the ``window`` rows before it.

    All windows are asked at once in a structure of ranks over the chunk. Without a value in the
    window a row stays as it is.
    """
    values = x.to_numpy(dtype=float)
    known = ~np.isnan(values)
    place = np.r_[0, np.cumsum(known)]  # known values before each row
    row = np.flatnonzero(known)
    start, end = place[np.maximum(0, row - window)], place[row]
    asked = end > start
    row, start, end = row[asked], start[asked], end[asked]
    out = values.copy()
    if len(row):
        past = OrderStatistics(values[known])
        out[row] = np.minimum(np.maximum(values[row], past.quantile(start, end, low)), past.quantile(start, end, high))
    return pd.Series(out, index=x.index)


def zscore_values(x: pd.Series, window: int) -> pd.Series:
    """(previous value - mean) / std over the ``window`` rows before; 0 where the past is constant.

    Sums of the frames are differences of running sums, in extended precision around the mean of
    all rows. A constant frame is told by counting changes, not by its rounding error.
    """
    values = x.to_numpy(dtype=float)
    n = len(values)
    known = ~np.isnan(values)
    compact = values[known]
    if not len(compact):
        return pd.Series(np.full(n, np.nan), index=x.index)
    center = compact.mean()
    shifted = (compact - center).astype(np.longdouble)
    total, squares = np.r_[0, np.cumsum(shifted)], np.r_[0, np.cumsum(shifted * shifted)]
    changes = np.r_[0, 0, np.cumsum(compact[1:] != compact[:-1])]
    place = np.r_[0, np.cumsum(known)]  # known values before each row
    row = np.arange(n)
    start, end = place[np.maximum(0, row - window)], place[row]
    count = np.maximum(1, end - start)
    mean = (total[end] - total[start]) / count
    spread = np.sqrt(np.maximum(0, (squares[end] - squares[start]) / count - mean * mean)).astype(float)
    steady = changes[end] == changes[np.minimum(start + 1, len(compact))]
    previous = np.r_[np.nan, values[:-1]]
    flat = steady | (spread < STD_FLOOR)
    z = (previous - center - mean.astype(float)) / np.where(flat, 1.0, spread)
    return pd.Series(np.where(np.isnan(previous), np.nan, np.where(flat, 0.0, z)), index=x.index)


def winsor_zscores_in(pieces: DataFrame, axis: Axis, cols: dict[str, str], window: int, low: float, high: float) -> DataFrame:
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {out: zscore_values(winsor_values(pdf[c].astype(float), window, low, high), window) for c, out in cols.items()}
        )

    return over_pandas(pieces, axis, fn, {out: "double" for out in cols.values()})


def quantile_of(values: Column, q: float) -> Column:
    """Linearly interpolated quantile of a sorted array column."""
    at = (F.size(values) - 1) * F.lit(q)
    i = F.floor(at).cast("int")
    low = F.get(values, i)
    return low + (F.coalesce(F.get(values, i + 1), low) - low) * (at - i)


def clip_to_past(x: Column, frame, low: float, high: float, d: DataFrame, out: str) -> DataFrame:
    """Clip ``x`` to the quantiles of its frame; short frames are sorted as arrays inside the JVM."""
    d = d.withColumn("_q", F.array_sort(F.collect_list(x).over(frame)))
    clipped = F.least(F.greatest(x, quantile_of(F.col("_q"), low)), quantile_of(F.col("_q"), high))
    return d.withColumn(out, F.when(x.isNotNull(), clipped)).drop("_q")


def winsorize_causal(
    df: DataFrame, axis: Axis, col: str, window: int, low: float = 0.01, high: float = 0.99, out: str | None = None, method: str = "auto"
) -> DataFrame:
    """Clip to the quantiles of rows [t-window, t-1].

    ``sql`` sorts every frame, for short ones; ``pandas`` asks all frames of a chunk in one
    structure of ranks and is used for wider frames under ``auto``.
    """
    out = out or col
    if method == "sql" or (method == "auto" and window <= SQL_FRAME_LIMIT):

        def build(d: DataFrame, w) -> DataFrame:
            frame = w.rowsBetween(-window, -1)
            return clip_to_past(F.col(col).cast("double"), frame, low, high, d, out)

        return over_frames(df, axis, build, back=window)
    pieces = chunked(df, axis, back=window)
    return owned(
        over_pandas(
            pieces,
            axis,
            lambda p: pd.DataFrame({out: winsor_values(p[col].astype(float), window, low, high)}),
            {out: "double"},
            drop=(out,) if out in df.columns else (),
        )
    )


def zscore_causal(df: DataFrame, axis: Axis, col: str, window: int, out: str, method: str = "auto") -> DataFrame:
    """(x[t-1] - mean) / std over rows [t-window, t-1]; population std, 0 when it vanishes."""
    if method == "sql" or (method == "auto" and window <= 4 * SQL_FRAME_LIMIT):

        def build(d: DataFrame, w) -> DataFrame:
            frame = w.rowsBetween(-window, -1)
            x = F.col(col).cast("double")
            prev, mean, std = F.lag(x).over(w), F.avg(x).over(frame), F.stddev_pop(x).over(frame)
            return d.withColumn(out, F.when(std >= STD_FLOOR, (prev - mean) / std).when(prev.isNotNull(), 0.0))

        return over_frames(df, axis, build, back=window)
    pieces = chunked(df, axis, back=window + 1)
    return owned(
        over_pandas(pieces, axis, lambda p: pd.DataFrame({out: zscore_values(p[col].astype(float), window)}), {out: "double"})
    )


def true_range(high: Column, low: Column, prev_close: Column) -> Column:
    return F.greatest(F.abs(high - low), F.abs(high - prev_close), F.abs(low - prev_close))


def atr_pct(df: DataFrame, axis: Axis, window: int = 14, out: str = "atr_pct") -> DataFrame:
    """Mean true range of the ``window`` bars before t over the previous close, winsorised."""
    pieces = chunked(df, axis, back=atr_reach(window))
    return owned(atr_pct_in(pieces, axis, window, out))


def atr_reach(window: int) -> int:
    return 2 * window + 2


def atr_pct_in(pieces: DataFrame, axis: Axis, window: int, out: str) -> DataFrame:
    w = chunk_window(axis)
    past = w.rowsBetween(-window, -1)
    prev = F.lag("close").over(w)
    d = pieces.withColumn("_pc", prev)
    d = d.withColumn("_tr", true_range(F.col("high"), F.col("low"), F.col("_pc")))
    atr = F.when(F.count("_tr").over(past) == window, F.avg("_tr").over(past))
    raw = F.coalesce(finite(F.try_divide(atr, F.when(F.col("_pc") != 0, F.col("_pc")))), F.lit(0.0))
    # The first bars have no full past and count as 0, also inside the clipping frame.
    d = clip_to_past(F.col("_raw"), past, 0.01, 0.99, d.withColumn("_raw", raw), out)
    return d.drop("_pc", "_tr", "_raw")


AGGREGATES = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count, "stddev": F.stddev_pop}


def rolling_rows(df: DataFrame, axis: Axis, col: str, n: int, fn: str, out: str) -> DataFrame:
    """Aggregate of the current and the n-1 rows before."""
    return over_frames(
        df, axis, lambda d, w: d.withColumn(out, AGGREGATES[fn](col).over(w.rowsBetween(-(n - 1), 0))), back=n - 1
    )


def rolling_time(df: DataFrame, axis: Axis, cols: dict[str, str], span_us: int, fn: str = "sum") -> DataFrame:
    """Aggregate of (t - span, t] for each column (input -> output)."""

    def build(d: DataFrame, w) -> DataFrame:
        frame = chunk_window(axis.with_(ties=())).rangeBetween(-(span_us - 1), 0)
        for c, out in cols.items():
            d = d.withColumn(out, AGGREGATES[fn](c).over(frame))
        return d

    return over_frames(df, axis, build, back_us=span_us)


def share_of(df: DataFrame, axis: Axis, part: str, other: str, out: str, span_us: int) -> DataFrame:
    """part / (part + other) over rolling time sums; a zero denominator counts as 1e-9."""
    d = df.fillna(0.0, subset=[part, other])
    d = rolling_time(d, axis, {part: "_a", other: "_b"}, span_us)
    total = F.col("_a") + F.col("_b")
    return d.withColumn(out, F.col("_a") / F.when(total == 0, 1e-9).otherwise(total)).drop("_a", "_b")


def cumulative(df: DataFrame, axis: Axis, cols: dict[str, str]) -> DataFrame:
    """Running sums from the start of the key: chunk totals first, then sums inside chunks."""

    def build(d: DataFrame, w) -> DataFrame:
        frame = w.rowsBetween(Window.unboundedPreceding, 0)
        for c, out in cols.items():
            d = d.withColumn(out, F.col(f"_before_{c}") + F.sum(F.coalesce(F.col(c), F.lit(0.0))).over(frame))
        return d

    return over_frames(df, axis, build, sums={c: F.coalesce(F.col(c), F.lit(0.0)).cast("double") for c in cols})


def rolling_pctile(df: DataFrame, axis: Axis, cols: dict[str, str], span_us: int = 30 * DAY, default: float = 0.5) -> DataFrame:
    """Share of the values in (t - span, t] that are not above the current one.

    A sorted sliding window per chunk, O(log n) per row; NULL rows do not count and get
    ``default``.
    """
    pieces = chunked(df, axis, back_us=span_us)

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        at = pd.to_datetime(pdf["_us"], unit="us")
        out = {}
        for c, name in cols.items():
            s = pd.Series(pdf[c].astype(float).to_numpy(), index=at)
            rank = s.rolling(f"{span_us}us", min_periods=1).rank(method="max", pct=True)
            out[name] = rank.where(s.notna()).fillna(default).to_numpy()
        return pd.DataFrame(out)

    return owned(over_pandas(pieces, axis, fn, {name: "double" for name in cols.values()}))


def log_return(df: DataFrame, axis: Axis, close: str = "close", out: str = "ret") -> DataFrame:
    """log(close / previous close), 0 where either is missing or not positive."""
    return over_frames(df, axis, lambda d, w: d.withColumn(out, safe_log_ratio(close, F.lag(close).over(w))), back=1)


def lagged(df: DataFrame, axis: Axis, col: str, n: int, out: str) -> DataFrame:
    """The value n rows before (n > 0) or after (n < 0)."""
    fn = (lambda w: F.lag(col, n).over(w)) if n > 0 else (lambda w: F.lead(col, -n).over(w))
    return over_frames(df, axis, lambda d, w: d.withColumn(out, fn(w)), back=max(n, 0), ahead=max(-n, 0))


def difference(df: DataFrame, axis: Axis, col: str, out: str) -> DataFrame:
    return over_frames(df, axis, lambda d, w: d.withColumn(out, F.col(col) - F.lag(col).over(w)), back=1)


def drop_warmup(df: DataFrame, axis: Axis, rows: int) -> DataFrame:
    """Remove the first ``rows`` rows of each key."""
    pos = F.col("_base") + F.row_number().over(chunk_window(axis)) - 1
    return over_frames(df, axis, lambda d, w: d.withColumn("_pos", pos)).where(F.col("_pos") >= rows).drop("_pos")


def transitions(df: DataFrame, axis: Axis, state: str) -> DataFrame:
    """Rows at which ``state`` differs from the row before (the first row is none)."""

    def build(d: DataFrame, w) -> DataFrame:
        return d.withColumn("_prev", F.lag(state).over(w))

    return over_frames(df, axis, build, back=1).where(F.col(state) != F.col("_prev")).drop("_prev")


def has_future(df: DataFrame, axis: Axis, rows: int, out: str = "has_future") -> DataFrame:
    """Whether at least ``rows`` rows follow."""
    return over_frames(
        df, axis, lambda d, w: d.withColumn(out, F.count(F.lit(1)).over(w.rowsBetween(1, rows)) == rows), ahead=rows
    )


def tail_per_key(df: DataFrame, axis: Axis, n: int) -> DataFrame:
    """The last n rows of every key; buckets before the tail are dropped ahead of the shuffle."""
    pieces = chunked(df, axis).where(F.col("_end") > F.col("_total") - n)
    # Only whole leading buckets are gone, so rows are counted from the end of the chunk.
    back = Window.partitionBy(*axis.keys, "_chunk").orderBy(F.desc("_us"), *[F.desc(t) for t in axis.ties])
    last = F.max("_end").over(Window.partitionBy(*axis.keys, "_chunk"))
    from_end = F.row_number().over(back) + F.col("_total") - F.col("_last")
    return owned(pieces.withColumn("_last", last).withColumn("_r", from_end).where(F.col("_r") <= n).drop("_r", "_last"))
