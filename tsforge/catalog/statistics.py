"""Past-only statistics and row operators of a series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tsforge.catalog import Registry
from tsforge.catalog.data import BARS, DAILY, SQL_BARS, SQL_DAILY, bars, daily, out, r
from tsforge.functions.timeunits import DAY, HOUR
from tsforge.operators import causal
from tsforge.operators.layout import over_frames, with_position

ENTRIES = Registry()
entry = ENTRIES.entry

W = "PARTITION BY symbol ORDER BY ts_us"
RET = f"CASE WHEN close > 0 AND lag(close) OVER ({W}) > 0 THEN ln(close / lag(close) OVER ({W})) ELSE 0 END"


@entry(
    f"""WITH {SQL_BARS}, q AS (SELECT *, {RET} AS ret FROM bars),
  s AS (SELECT *, sum(ret) OVER ({W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS ret_12,
        sum(ret) OVER ({W} ROWS BETWEEN 47 PRECEDING AND CURRENT ROW) AS ret_48,
        lag(ret) OVER ({W}) AS prev, avg(ret) OVER p AS m, stddev_pop(ret) OVER p AS sd
        FROM q WINDOW p AS ({W} ROWS BETWEEN 96 PRECEDING AND 1 PRECEDING))
  SELECT symbol, ts_us, {r('ret','ret')}, {r('ret_12','ret_12')}, {r('ret_48','ret_48')},
    {r('CASE WHEN sd >= 1e-12 THEN (prev - m) / sd WHEN prev IS NOT NULL THEN 0 END','ret_z')} FROM s"""
)
def bar_return_zscore(spark, sf):
    def build(d, w):
        d = d.withColumn("ret", causal.safe_log_ratio("close", F.lag("close").over(w)))
        past = w.rowsBetween(-96, -1)
        d = d.withColumn("ret_12", F.sum("ret").over(w.rowsBetween(-11, 0)))
        d = d.withColumn("ret_48", F.sum("ret").over(w.rowsBetween(-47, 0)))
        sd, prev = F.stddev_pop("ret").over(past), F.lag("ret").over(w)
        z = F.when(sd >= causal.STD_FLOOR, (prev - F.avg("ret").over(past)) / sd).when(prev.isNotNull(), 0.0)
        return d.withColumn("ret_z", z)

    d = over_frames(bars(spark, sf), BARS, build, back=98)
    return out(d, "symbol", "ts", "ret", "ret_12", "ret_48", "ret_z")


def _winsor_sql(src: str, window: int) -> str:
    return f"""x AS (SELECT symbol, ts_us, close,
    quantile_cont(close, 0.01) OVER ({W} ROWS BETWEEN {window} PRECEDING AND 1 PRECEDING) AS lo,
    quantile_cont(close, 0.99) OVER ({W} ROWS BETWEEN {window} PRECEDING AND 1 PRECEDING) AS hi FROM {src})
  SELECT symbol, ts_us, {r('least(greatest(close, coalesce(lo, close)), coalesce(hi, close))', 'close_w')} FROM x"""


@entry(f"WITH {SQL_BARS}, {_winsor_sql('bars', 288)}")
def winsorize_wide(spark, sf):
    return out(causal.winsorize_causal(bars(spark, sf), BARS, "close", 288, out="close_w"), "symbol", "ts", "close_w")


@entry(f"WITH {SQL_BARS}, {_winsor_sql('bars', 24)}")
def winsorize_narrow(spark, sf):
    return out(causal.winsorize_causal(bars(spark, sf), BARS, "close", 24, out="close_w"), "symbol", "ts", "close_w")


def _z_sql(src: str, window: int) -> str:
    p = f"OVER ({W} ROWS BETWEEN {window} PRECEDING AND 1 PRECEDING)"
    return f"""x AS (SELECT symbol, ts_us, lag(volume) OVER ({W}) AS prev, avg(volume) {p} AS m, stddev_pop(volume) {p} AS sd FROM {src})
  SELECT symbol, ts_us, {r('CASE WHEN sd >= 1e-12 THEN (prev - m) / sd WHEN prev IS NOT NULL THEN 0 END', 'z')} FROM x"""


@entry(f"WITH {SQL_BARS}, {_z_sql('bars', 48)}")
def zscore_narrow(spark, sf):
    return out(causal.zscore_causal(bars(spark, sf), BARS, "volume", 48, "z"), "symbol", "ts", "z")


@entry(f"WITH {SQL_DAILY}, {_z_sql('daily', 864)}")
def zscore_wide(spark, sf):
    return out(causal.zscore_causal(daily(spark, sf), DAILY, "volume", 864, "z"), "symbol", "ts", "z")


ATR = f"""
tr0 AS (SELECT *, lag(close) OVER ({W}) AS pc FROM bars),
tr1 AS (SELECT *, greatest(abs(high - low), abs(high - pc), abs(low - pc)) AS tr FROM tr0),
tr2 AS (SELECT *, CASE WHEN count(tr) OVER p = 14 THEN avg(tr) OVER p END AS atr FROM tr1
        WINDOW p AS ({W} ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)),
tr3 AS (SELECT *, coalesce(atr / nullif(pc, 0), 0) AS raw FROM tr2),
atr AS (SELECT symbol, ts_us, open, high, low, close, volume,
        least(greatest(raw, coalesce(quantile_cont(raw, 0.01) OVER p, raw)), coalesce(quantile_cont(raw, 0.99) OVER p, raw)) AS atr_pct
        FROM tr3 WINDOW p AS ({W} ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))"""


@entry(f"WITH {SQL_BARS}, {ATR} SELECT symbol, ts_us, {r('atr_pct', 'atr_pct')} FROM atr")
def atr_percent(spark, sf):
    return out(causal.atr_pct(bars(spark, sf), BARS, 14), "symbol", "ts", "atr_pct")


@entry(
    f"""WITH {SQL_BARS} SELECT symbol, ts_us, {r(f"sum(volume) OVER ({W} ROWS BETWEEN 47 PRECEDING AND CURRENT ROW)", 'vol_48')} FROM bars"""
)
def rolling_row_sum(spark, sf):
    return out(causal.rolling_rows(bars(spark, sf), BARS, "volume", 48, "sum", "vol_48"), "symbol", "ts", "vol_48")


@entry(
    f"""WITH {SQL_BARS} SELECT symbol, ts_us, {r(f"sum(volume) OVER ({W} RANGE BETWEEN {6 * HOUR - 1} PRECEDING AND CURRENT ROW)", 'vol_6h')} FROM bars"""
)
def rolling_time_sum(spark, sf):
    return out(causal.rolling_time(bars(spark, sf), BARS, {"volume": "vol_6h"}, 6 * HOUR), "symbol", "ts", "vol_6h")


@entry(
    f"""WITH {SQL_BARS}, s AS (SELECT symbol, ts_us,
    sum(open) OVER t AS a, sum(close) OVER t AS b FROM bars WINDOW t AS ({W} RANGE BETWEEN {6 * HOUR - 1} PRECEDING AND CURRENT ROW))
  SELECT symbol, ts_us, {r('a / CASE WHEN a + b = 0 THEN 1e-9 ELSE a + b END', 'share')} FROM s"""
)
def rolling_share(spark, sf):
    return out(causal.share_of(bars(spark, sf), BARS, "open", "close", "share", 6 * HOUR), "symbol", "ts", "share")


@entry(
    f"""WITH {SQL_BARS} SELECT symbol, ts_us, {r(f"sum(close - open) OVER ({W})", 'cvd', 4)} FROM bars"""
)
def cumulative_delta(spark, sf):
    b = bars(spark, sf).withColumn("net", F.col("close") - F.col("open"))
    d = causal.cumulative(b, BARS.with_(chunk_rows=100), {"net": "cvd"})
    return out(d, "symbol", "ts", "cvd", cvd=4)


@entry(
    f"""WITH {SQL_BARS}, l AS (SELECT symbol, ts_us, close, list(close) OVER ({W} RANGE BETWEEN {10 * DAY - 1} PRECEDING AND CURRENT ROW) AS past FROM bars)
  SELECT symbol, ts_us, {r('len(list_filter(past, lambda v: v <= close)) / len(past)', 'pctile')} FROM l"""
)
def rolling_percentile(spark, sf):
    return out(causal.rolling_pctile(bars(spark, sf), BARS, {"close": "pctile"}, 10 * DAY), "symbol", "ts", "pctile")


@entry(f"WITH {SQL_BARS} SELECT symbol, ts_us, {r(RET, 'ret')}, {r(f'power({RET}, 2)', 'rv')} FROM bars")
def log_return(spark, sf):
    d = causal.log_return(bars(spark, sf), BARS).withColumn("rv", F.pow("ret", F.lit(2)))
    return out(d, "symbol", "ts", "ret", "rv")


@entry(
    f"""WITH {SQL_BARS} SELECT symbol, ts_us, {r(f'lag(close, 3) OVER ({W})', 'lag3')}, {r(f'lead(close, 3) OVER ({W})', 'lead3')},
  {r(f'close - lag(close) OVER ({W})', 'diff')} FROM bars"""
)
def lag_lead_diff(spark, sf):
    b = bars(spark, sf)

    def build(d, w):
        d = d.withColumn("lag3", F.lag("close", 3).over(w)).withColumn("lead3", F.lead("close", 3).over(w))
        return d.withColumn("diff", F.col("close") - F.lag("close").over(w))

    return out(over_frames(b, BARS.with_(chunk_rows=64), build, back=3, ahead=3), "symbol", "ts", "lag3", "lead3", "diff")


@entry(f"WITH {SQL_BARS}, p AS (SELECT symbol, ts_us, row_number() OVER ({W}) - 1 AS pos FROM bars) SELECT symbol, ts_us, CAST(pos AS BIGINT) AS pos FROM p WHERE pos >= 100")
def drop_warmup(spark, sf):
    d = causal.drop_warmup(bars(spark, sf), BARS.with_(chunk_rows=64), 100)
    return out(with_position(bars(spark, sf), BARS).join(d.select("symbol", "ts"), ["symbol", "ts"], "left_semi"), "symbol", "ts", "pos")


@entry(
    f"""WITH {SQL_BARS}, t AS (SELECT symbol, ts_us, CAST(close > 50 AS INTEGER) AS high, lag(CAST(close > 50 AS INTEGER)) OVER ({W}) AS prev FROM bars)
  SELECT symbol, ts_us, high FROM t WHERE high <> prev"""
)
def state_transitions(spark, sf):
    b = bars(spark, sf).withColumn("high", (F.col("close") > 50).cast("int"))
    return out(causal.transitions(b.select("symbol", "ts", "high"), BARS.with_(chunk_rows=64), "high"), "symbol", "ts", "high")


@entry(
    f"""WITH {SQL_BARS} SELECT symbol, ts_us, CAST(count(*) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND 36 FOLLOWING) = 36 AS INTEGER) AS has_future FROM bars"""
)
def future_rows_available(spark, sf):
    return out(causal.has_future(bars(spark, sf), BARS, 36), "symbol", "ts", "has_future")


@entry(
    f"""WITH {SQL_BARS}, p AS (SELECT symbol, ts_us, close, row_number() OVER (PARTITION BY symbol ORDER BY ts_us DESC) AS rn FROM bars)
  SELECT symbol, ts_us, {r('close', 'close')} FROM p WHERE rn <= 20"""
)
def tail_per_key(spark, sf):
    return out(causal.tail_per_key(bars(spark, sf), BARS.with_(bucket_us=DAY, chunk_rows=13), 20), "symbol", "ts", "close")
