"""Resampling, grids, gap filling and joins of measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from tsforge.catalog import Registry
from tsforge.catalog.data import BARS, H, SQL_BARS, SQL_DAILY, SQL_TICKS, TICKS, bars, daily, out, r, table, ticks
from tsforge.functions.timeunits import DAY, HOUR, micros
from tsforge.operators import align

ENTRIES = Registry()
entry = ENTRIES.entry


@entry(f"WITH {SQL_BARS} SELECT symbol, ts_us, {r('open','open')}, {r('high','high')}, {r('low','low')}, {r('close','close')}, volume FROM bars")
def resample_ohlcv(spark, sf):
    t = ticks(spark, sf).select("symbol", "ts", "value", "user_id", "event_id")
    d = align.resample_ohlcv(t, TICKS, HOUR, price="value", volume="user_id")
    return out(d, "symbol", "ts", "open", "high", "low", "close", "volume")


@entry(f"WITH {SQL_DAILY} SELECT symbol, ts_us, {r('open','open')}, {r('high','high')}, {r('low','low')}, {r('close','close')}, volume FROM daily")
def resample_daily(spark, sf):
    return out(daily(spark, sf), "symbol", "ts", "open", "high", "low", "close", "volume")


GRID = f"""
grid AS (
  SELECT symbol, unnest(range(lo, hi + 1, {H})) AS ts_us
  FROM (SELECT symbol, min(ts_us) AS lo, max(ts_us) AS hi FROM bars GROUP BY 1)
)"""


@entry(
    f"""WITH {SQL_TICKS},
  raw AS (SELECT symbol, ((us + {H - 1}) // {H}) * {H} AS ts_us, sum(value) AS value, CAST(sum(user_id) AS DOUBLE) AS user_id, min(us) AS f FROM ticks GROUP BY 1, 2),
  span AS (SELECT symbol, min(ts_us) AS lo, max(ts_us) AS hi, min(f) AS f FROM raw GROUP BY 1),
  grid AS (SELECT symbol, f, unnest(range(lo, hi + 1, {H})) AS ts_us FROM span)
  SELECT symbol, ts_us, {r('coalesce(value, 0)', 'value')}, coalesce(user_id, 0) AS user_id
  FROM grid LEFT JOIN raw USING (symbol, ts_us) WHERE ts_us > (grid.f // {DAY}) * {DAY}"""
)
def resample_sum(spark, sf):
    t = ticks(spark, sf)
    return out(align.resample_sum(t, TICKS, HOUR, ["value", "user_id"]), "symbol", "ts", "value", "user_id")


@entry(
    f"""WITH {SQL_TICKS} SELECT symbol, ((us + {H - 1}) // {H}) * {H} AS ts_us, {r('arg_max(value, (us, event_id))', 'value')},
  arg_max(user_id, (us, event_id)) AS user_id FROM ticks GROUP BY 1, 2"""
)
def resample_last(spark, sf):
    return out(align.resample_last(ticks(spark, sf), TICKS, HOUR, ["value", "user_id"]), "symbol", "ts", "value", "user_id")


@entry(f"WITH {SQL_BARS}, {GRID} SELECT symbol, ts_us FROM grid")
def time_grid(spark, sf):
    return out(align.time_grid(bars(spark, sf), BARS, HOUR), "symbol", "ts")


@entry(f"WITH {SQL_BARS}, {GRID} SELECT symbol, ts_us FROM grid ANTI JOIN bars USING (symbol, ts_us)")
def missing_bars(spark, sf):
    return out(align.missing_ts(bars(spark, sf), BARS, HOUR, None), "symbol", "ts")


@entry(
    f"""WITH {SQL_BARS}, {GRID},
  g AS (SELECT symbol, ts_us, close, last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ts_us ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS filled
        FROM grid LEFT JOIN bars USING (symbol, ts_us))
  SELECT symbol, ts_us, {r('filled', 'close')}, CAST(close IS NULL AND filled IS NOT NULL AS INTEGER) AS close_imputed FROM g"""
)
def ffill_on_grid(spark, sf):
    d = align.ffill_limit(bars(spark, sf).select("symbol", "ts", "close"), BARS, ["close"], 3, every=HOUR)
    return out(d, "symbol", "ts", "close", "close_imputed")


@entry(
    f"""WITH {SQL_BARS},
  x AS (SELECT symbol, ts_us, CASE WHEN close > 30 THEN close END AS c FROM bars),
  g AS (SELECT *, last_value(c IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ts_us ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS filled FROM x)
  SELECT symbol, ts_us, {r('filled', 'c')}, CAST(c IS NULL AND filled IS NOT NULL AS INTEGER) AS _imputed_c FROM g"""
)
def ffill_rows(spark, sf):
    d = bars(spark, sf).select("symbol", "ts", F.when(F.col("close") > 30, F.col("close")).alias("c"))
    return out(align.ffill_limit(d, BARS, ["c"], 3, flag="_imputed_{}"), "symbol", "ts", "c", "_imputed_c")


@entry(f"WITH {SQL_TICKS} SELECT event_id, (us // {H}) * {H} + {H} AS bar_us FROM ticks")
def align_to_next_bar(spark, sf):
    return ticks(spark, sf).select("event_id", micros(align.align_up("ts", HOUR)).alias("bar_us"))


SQL_MEASURES = f"""
m_open AS (SELECT symbol, ts_us, count(*) AS n_ticks FROM (SELECT symbol, ((us + {H - 1}) // {H}) * {H} AS ts_us FROM ticks) GROUP BY 1, 2),
m_big AS (SELECT symbol, ((us + {H - 1}) // {H}) * {H} AS ts_us, sum(value) AS big FROM ticks WHERE value > 100 GROUP BY 1, 2),
m_low AS (SELECT symbol, ((us + {H - 1}) // {H}) * {H} AS ts_us, sum(value) AS small FROM ticks WHERE value <= 10 GROUP BY 1, 2)"""


def _measures(spark, sf):
    t = ticks(spark, sf).select("symbol", "value", align.ceil_to(micros("ts"), HOUR).alias("bar_us"))
    n = t.groupBy("symbol", "bar_us").agg(F.count(F.lit(1)).alias("n_ticks"))
    big = t.where("value > 100").groupBy("symbol", "bar_us").agg(F.sum("value").alias("big"))
    small = t.where("value <= 10").groupBy("symbol", "bar_us").agg(F.sum("value").alias("small"))
    return n, big, small


@entry(
    f"""WITH {SQL_BARS}, {SQL_MEASURES}
  SELECT symbol, ts_us AS bar_us, {r('close', 'close')}, n_ticks, {r('big', 'big')}, {r('small', 'small')}
  FROM bars LEFT JOIN m_open USING (symbol, ts_us) LEFT JOIN m_big USING (symbol, ts_us) LEFT JOIN m_low USING (symbol, ts_us)"""
)
def join_measures(spark, sf):
    base = bars(spark, sf).select("symbol", micros("ts").alias("bar_us"), "close")
    d = align.join_measures(base, list(_measures(spark, sf)), ["symbol", "bar_us"])
    return out(d, "symbol", "bar_us", "close", "n_ticks", "big", "small")


@entry(
    f"""WITH {SQL_TICKS}, {SQL_MEASURES}
  SELECT symbol, ts_us AS bar_us, {r('big', 'big')}, {r('small', 'small')} FROM m_big FULL JOIN m_low USING (symbol, ts_us)"""
)
def outer_measures(spark, sf):
    _, big, small = _measures(spark, sf)
    return out(align.combine_measures([big, small], ["symbol", "bar_us"]), "symbol", "bar_us", "big", "small")


@entry(
    f"""WITH s AS (SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS src, o_custkey, o_totalprice FROM orders),
  b AS (SELECT o_custkey, min(src) AS best FROM s GROUP BY 1)
  SELECT s.o_custkey, CAST(s.src AS INTEGER) AS src, count(*) AS n, {r('sum(o_totalprice)', 'total', 2)} FROM s JOIN b ON s.o_custkey = b.o_custkey AND s.src = b.best GROUP BY 1, 2"""
)
def source_fallback(spark, sf):
    """Every order belongs to one of five sources, by priority."""
    o = table(spark, sf, "orders").select("o_custkey", "o_totalprice", "o_orderpriority")
    sources = [o.where(F.col("o_orderpriority").startswith(str(k + 1))).withColumn("src", F.lit(k)) for k in range(5)]
    d = align.first_source(sources, ["o_custkey"]).groupBy("o_custkey", "src")
    return out(d.agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")), "o_custkey", "src", "n", "total", total=2)


@entry(
    """SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
  arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS o_orderpriority FROM orders GROUP BY 1"""
)
def latest_per_key(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    return align.keep_last(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")
