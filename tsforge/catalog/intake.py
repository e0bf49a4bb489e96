"""Landing records, lakes, day plans and streams."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.sql import functions as F

from tsforge.catalog import Registry
from tsforge.catalog.data import BARS, H, SQL_BARS, SQL_TICKS, TICKS, bars, out, r, table, ticks
from tsforge.catalog.decisions import SQL_POLICY, policy_rows
from tsforge.functions.scalars import decision_id
from tsforge.functions.timeunits import DAY, HOUR, micros
from tsforge.operators import explain, policy
from tsforge.operators.align import resample_ohlcv
from tsforge.operators.layout import with_position
from tsforge.operators.ranks import exact_quantiles
from tsforge.operators.scan import run_states
from tsforge.plans.bars import BarSources, build_bars, compose_measures, taker_ratio
from tsforge.session import apply_settings, scratch_path
from tsforge.sources import lake, landing
from tsforge.streaming import jobs, states

ENTRIES = Registry()
entry = ENTRIES.entry


def payloads(spark, sf):
    """Vendor-like documents built from the ticks: 50 records each, lists at varying places."""
    t = ticks(spark, sf)
    kind = F.floor(F.col("event_id") / 50) % 3
    ms = F.floor(micros("ts") / 1000)
    close = F.when(F.col("value") < 2, F.lit("bad")).otherwise(F.col("value").cast("string"))
    rec = F.struct(
        F.col("event_id").alias("id"), ms.alias("t"), F.col("value").cast("string").alias("o"), F.col("value").cast("string").alias("h"), F.col("value").cast("string").alias("l"),
        close.alias("c"), F.col("user_id").alias("volumeUsd"),
    )
    docs = t.select("symbol", F.floor(F.col("event_id") / 50).alias("doc"), kind.alias("kind"), rec.alias("rec")).groupBy("symbol", "doc", "kind").agg(F.collect_list("rec").alias("items"))
    other = F.lit('[{"code": 1}]')
    text = F.to_json("items")
    payload = (
        F.when(F.col("kind") == 0, text)
        .when(F.col("kind") == 1, F.concat(F.lit('{"code":"0","list":'), other, F.lit(',"data":'), text, F.lit("}")))
        .otherwise(F.concat(F.lit('{"code":"0","data":{"list":'), text, F.lit("}}")))
    )
    return docs.select("symbol", "doc", payload.alias("payload"))


@entry(
    f"WITH {SQL_TICKS} SELECT symbol, event_id // 50 AS doc, (us // 1000) * 1000 AS ts_us, {r('value', 'open')}, {r('value', 'close')}, CAST(user_id AS DOUBLE) AS volume_usd FROM ticks WHERE value >= 2"
)
def landed_records(spark, sf):
    good, _ = landing.normalise_records(payloads(spark, sf), "payload", landing.PRICE)
    return out(good, "symbol", "doc", "ts", "open", "close", "volume_usd")


@entry(f"WITH {SQL_TICKS} SELECT symbol, event_id // 50 AS doc, count(*) AS n FROM ticks WHERE value < 2 GROUP BY 1, 2")
def landed_rejects(spark, sf):
    _, bad = landing.normalise_records(payloads(spark, sf), "payload", landing.PRICE)
    return bad.groupBy("symbol", "doc").agg(F.count(F.lit(1)).alias("n"))


def _typed_payloads(spark, sf):
    """Vendor-like documents of 50 records each that carry the fields of all record types, some of them zero or absent."""
    t = ticks(spark, sf)
    k, v = F.col("event_id"), F.col("value")
    rec = F.struct(
        F.floor(micros("ts") / 1000).alias("time"),
        F.when(k % 3 != 0, v).alias("oi"),
        F.when(k % 4 == 0, 0.0).otherwise(v / 1000).alias("fundingRate"), F.when(k % 8 == 0, 0.5).alias("value"),
        F.when(k % 5 != 0, v * 2).alias("buyUsd"), F.when(k % 6 == 0, F.lit("x")).otherwise((v * 3).cast("string")).alias("sell_usd"),
        F.when(k % 7 != 0, v * 4).alias("amountUsd"),
    )
    docs = t.select("symbol", F.floor(k / 50).alias("doc"), rec.alias("rec")).groupBy("symbol", "doc").agg(F.collect_list("rec").alias("items"))
    return docs.select("symbol", F.concat(F.lit('{"data":{"rows":'), F.to_json("items"), F.lit("}}")).alias("payload"))


@entry(
    f"""WITH {SQL_TICKS}, x AS (SELECT symbol, value AS v, event_id AS k FROM ticks),
  g AS (SELECT 'open_interest' AS type, symbol, CASE WHEN k % 3 <> 0 THEN v END AS a, 0.0 AS b FROM x
    UNION ALL SELECT 'funding', symbol, CASE WHEN k % 4 = 0 THEN 0.0 ELSE v / 1000 END, 0 FROM x
    UNION ALL SELECT 'funding without zeros', symbol, CASE WHEN k % 8 = 0 THEN 0.5 WHEN k % 4 = 0 THEN NULL ELSE nullif(v / 1000, 0) END, 0 FROM x
    UNION ALL SELECT 'taker_volume', symbol, CASE WHEN k % 5 <> 0 THEN v * 2 ELSE 0 END, CASE WHEN k % 6 <> 0 THEN v * 3 ELSE 0 END FROM x
    UNION ALL SELECT 'liquidation', symbol, CASE WHEN k % 8 = 0 THEN 0.5 WHEN k % 7 <> 0 THEN v * 4 END, 0 FROM x)
  SELECT type, symbol, count(a) AS good, count(*) - count(a) AS bad, {r('sum(a)', 'first', 3)}, {r('sum(b) FILTER (a IS NOT NULL)', 'second', 3)} FROM g GROUP BY 1, 2"""
)
def landed_record_types(spark, sf):
    """The four other record types, and zeros that count as missing, with what each rejects."""
    raw = _typed_payloads(spark, sf)
    parts = None
    for name, spec, zero in (("open_interest", "open_interest", False), ("funding", "funding", False), ("funding without zeros", "funding", True), ("taker_volume", "taker_volume", False), ("liquidation", "liquidation", False)):
        good, bad = landing.normalise_records(raw, "payload", landing.SPECS[spec], ["symbol"], zero)
        cols = list(landing.SPECS[spec].fields)
        d = good.select("symbol", F.lit(1).alias("ok"), F.col(cols[0]).alias("a"), (F.col(cols[1]) if len(cols) > 1 else F.lit(0.0)).alias("b"))
        d = d.unionByName(bad.select("symbol", F.lit(0).alias("ok"), F.lit(None).cast("double").alias("a"), F.lit(None).cast("double").alias("b")))
        d = d.groupBy("symbol").agg(F.sum("ok").alias("good"), F.sum(1 - F.col("ok")).alias("bad"), F.sum("a").alias("first"), F.sum("b").alias("second")).withColumn("type", F.lit(name))
        parts = d if parts is None else parts.unionByName(d)
    return out(parts, "type", "symbol", "good", "bad", "first", "second", first=3, second=3)


@entry(
    f"""WITH {SQL_TICKS}, g AS (SELECT symbol, (us // 1000) * 1000 AS us, event_id, value, user_id FROM ticks WHERE value >= 2),
  b AS (SELECT symbol, ((us + {H - 1}) // {H}) * {H} AS ts_us, arg_min(value, (us, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (us, event_id)) AS close, CAST(sum(user_id) AS DOUBLE) AS volume FROM g GROUP BY 1, 2),
  f AS (SELECT symbol, min(us) AS us FROM g GROUP BY 1)
  SELECT b.symbol, ts_us, {r('open', 'open')}, {r('high', 'high')}, {r('low', 'low')}, {r('close', 'close')}, volume FROM b JOIN f USING (symbol) WHERE ts_us > (us // {DAY}) * {DAY}"""
)
def landing_to_lake(spark, sf):
    """One job from landed documents over typed records to bars in a day-partitioned lake, read back."""
    # Landed times are whole milliseconds; records that share one are ordered by their id.
    good, _ = landing.normalise_records(payloads(spark, sf), "payload", replace(landing.PRICE, numbers={"event_id": "id"}))
    path = scratch_path(spark, "lake")
    lake.write_daily(resample_ohlcv(good, TICKS.with_(ties=("event_id",)), HOUR, price="close", volume="volume_usd"), path)
    return out(lake.scan(spark, path), "symbol", "ts", "open", "high", "low", "close", "volume")


@entry(
    f"""WITH {SQL_TICKS} SELECT symbol, count(*) AS n, {r('sum(value)', 'total', 3)}, CAST(sum(us // 1000000) AS BIGINT) AS clock FROM ticks GROUP BY 1"""
)
def event_log_roundtrip(spark, sf):
    """Events appended as JSON lines and read back."""
    path = scratch_path(spark, "log")
    t = ticks(spark, sf).select("ts", F.lit("score").alias("type"), "symbol", F.col("value").alias("t_nn_ms"))
    lake.write_events(t, path)
    good, _ = lake.read_events(spark, path)
    d = good.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.sum("t_nn_ms").alias("total"), F.sum(F.floor(micros("ts") / 1_000_000)).alias("clock"))
    return out(d, "symbol", "n", "total", "clock", total=3)


@entry(
    """SELECT 'json' AS kind, o_orderpriority AS name, count(*) AS n FROM orders GROUP BY 2
  UNION ALL SELECT 'csv', o_orderpriority, count(*) FROM orders GROUP BY 2
  UNION ALL SELECT 'lineage', column_name, 1 FROM (DESCRIBE SELECT * FROM orders)"""
)
def reports_roundtrip(spark, sf):
    """A report as JSON, the same table as CSV, and the lineage of a table's columns, each written and read back."""
    o = table(spark, sf, "orders")
    mix = o.groupBy(F.col("o_orderpriority").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    json, csv, origin = (scratch_path(spark, n) for n in ("report", "table", "lineage"))
    lake.write_report(mix, json)
    lake.write_table_csv(mix, csv)
    lake.write_table_csv(lake.lineage(spark, [(c, "orders", "as landed") for c in o.columns]), origin)
    parts = [spark.read.schema("name string, n bigint").json(json).select(F.lit("json").alias("kind"), "name", "n")]
    parts.append(spark.read.option("header", "true").schema("name string, n bigint").csv(csv).select(F.lit("csv").alias("kind"), "name", "n"))
    parts.append(spark.read.option("header", "true").csv(origin).select(F.lit("lineage").alias("kind"), F.col("feature").alias("name"), F.lit(1).cast("long").alias("n")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@entry(
    f"""WITH {SQL_TICKS}, e AS (SELECT us // 1000000 AS t FROM ticks), m AS (SELECT max(t) AS now FROM e)
  SELECT count(*) FILTER (now - t > 5 * 86400) AS removed, count(*) FILTER (now - t <= 5 * 86400) AS kept, CAST(0 AS BIGINT) AS again FROM e, m"""
)
def document_expiry(spark, sf):
    """Documents older than their time to live are removed once; a second run finds none."""
    path = scratch_path(spark, "documents")
    docs = ticks(spark, sf).select(F.col("event_id").cast("string").alias("id"), F.floor(micros("ts") / 1_000_000).alias("ts_unix"), "symbol")
    docs.write.parquet(path)
    now = docs.agg(F.max("ts_unix")).first()[0]
    removed, again = explain.collect_garbage(spark, path, now, 5), explain.collect_garbage(spark, path, now, 5)
    return spark.read.parquet(path).agg(F.lit(removed).cast("long").alias("removed"), F.count(F.lit(1)).alias("kept"), F.lit(again).cast("long").alias("again"))


@entry(
    f"""WITH {SQL_TICKS}, s AS (SELECT symbol, us, value, CASE WHEN event_id % 7 < 3 AND symbol <> 'view' THEN 30 WHEN event_id % 7 < 5 THEN 7 ELSE 1 END AS d FROM ticks),
  m AS (SELECT symbol, max(d) AS d FROM s GROUP BY 1) SELECT symbol, count(*) AS n, {r('sum(value)', 'total', 3)} FROM s JOIN m USING (symbol, d) GROUP BY 1"""
)
def snapshot_ranges(spark, sf):
    t = ticks(spark, sf)
    d = F.when((F.col("event_id") % 7 < 3) & (F.col("symbol") != "view"), 30).when(F.col("event_id") % 7 < 5, 7).otherwise(1)
    best = landing.best_range(t.select("symbol", "ts", "value", d.alias("range_days")), ["symbol"])
    return out(best.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")), "symbol", "n", "total", total=3)


def _sources(spark, sf):
    t = ticks(spark, sf)
    price = t.select("symbol", "ts", "event_id", *[F.col("value").alias(c) for c in ("open", "high", "low", "close")], F.col("user_id").cast("double").alias("volume_usd"))
    pick = lambda m, k: t.where(F.col("event_id") % m == k)
    oi = pick(3, 0).select("symbol", "ts", "event_id", (F.col("value") * 2).alias("oi_now"))
    f1 = pick(4, 1).where("symbol <> 'view'").select("symbol", "ts", "event_id", (F.col("value") / 100).alias("funding_now"))
    f2 = pick(4, 2).select("symbol", "ts", "event_id", (F.col("value") / 50).alias("funding_now"))
    taker = t.select("symbol", "ts", "event_id", F.col("value").alias("taker_buy_usd"), F.col("user_id").cast("double").alias("taker_sell_usd"))
    liq = pick(5, 0).select("symbol", "ts", "event_id", F.col("value").alias("notional_usd"))
    return BarSources(price, oi, (f1, f2), taker, taker.where("event_id % 2 = 0"), taker.where("event_id % 2 = 1"), liq)


def _on_grid(name: str, src: str, agg: str) -> str:
    return f"""{name}_b AS (SELECT symbol, ((us + {H - 1}) // {H}) * {H} AS ts_us, {agg} FROM {src} GROUP BY 1, 2),
  {name}_g AS (SELECT symbol, unnest(range(lo, hi + 1, {H})) AS ts_us FROM (SELECT symbol, min(ts_us) AS lo, max(ts_us) AS hi FROM {name}_b GROUP BY 1))"""


def _filled(name: str, col: str) -> str:
    f = f"last_value({col} IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ts_us ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"
    return f"{name} AS (SELECT symbol, ts_us, {f} AS {col}, CAST({col} IS NULL AND {f} IS NOT NULL AS INTEGER) AS _imputed_{col} FROM {name}_g LEFT JOIN {name}_b USING (symbol, ts_us))"


SQL_LAKE = f"""{SQL_BARS},
{_on_grid('oi', '(SELECT * FROM ticks WHERE event_id % 3 = 0)', 'arg_max(value * 2, (us, event_id)) AS oi_now')}, {_filled('oi', 'oi_now')},
fs AS (SELECT symbol, us, event_id, value / 100 AS f FROM ticks WHERE event_id % 4 = 1 AND symbol <> 'view' UNION ALL SELECT symbol, us, event_id, value / 50 FROM ticks WHERE event_id % 4 = 2 AND symbol = 'view'),
{_on_grid('fu', 'fs', 'arg_max(f, (us, event_id)) AS funding_now')}, {_filled('fu', 'funding_now')},
tk AS (SELECT symbol, ((us + {H - 1}) // {H}) * {H} AS ts_us, sum(value) AS b, sum(user_id) AS s, sum(value) FILTER (event_id % 2 = 0) AS sb, sum(user_id) FILTER (event_id % 2 = 0) AS ss,
  sum(value) FILTER (event_id % 2 = 1) AS pb, sum(user_id) FILTER (event_id % 2 = 1) AS ps, sum(value) FILTER (event_id % 5 = 0) AS lq FROM ticks GROUP BY 1, 2),
lake AS (SELECT symbol, ts_us, open, high, low, close, volume, coalesce(oi_now, 0) AS oi_now, coalesce(_imputed_oi_now, 0) AS _imputed_oi_now, coalesce(funding_now, 0) AS funding_now, coalesce(_imputed_funding_now, 0) AS _imputed_funding_now,
  b, s, coalesce(sb, 0) AS sb, coalesce(ss, 0) AS ss, coalesce(pb, 0) AS pb, coalesce(ps, 0) AS ps, coalesce(lq, 0) AS lq
  FROM bars LEFT JOIN oi USING (symbol, ts_us) LEFT JOIN fu USING (symbol, ts_us) LEFT JOIN tk USING (symbol, ts_us))"""


@entry(
    f"""WITH {SQL_LAKE} SELECT symbol, ts_us, {r('close', 'close')}, volume AS volume_usd, {r('oi_now', 'oi_now')}, _imputed_oi_now, {r('funding_now', 'funding_now')}, _imputed_funding_now, {r('b', 'taker_buy_usd')},
  {r('s', 'taker_sell_usd')}, {r('sb', 'spot_taker_buy_usd')}, {r('ps', 'perp_taker_sell_usd')}, {r('lq', 'liq_notional_raw')} FROM lake"""
)
def bar_lake(spark, sf):
    d = build_bars(_sources(spark, sf), TICKS, HOUR)
    names = ["close", "oi_now", "funding_now", "taker_buy_usd", "taker_sell_usd", "spot_taker_buy_usd", "perp_taker_sell_usd", "liq_notional_raw"]
    d = d.withColumnRenamed("volume", "volume_usd")
    return out(d, "symbol", "ts", "volume_usd", "_imputed_oi_now", "_imputed_funding_now", *names)


@entry(
    f"""WITH {SQL_LAKE}, w AS (SELECT *, lag(close) OVER o AS pc, sum(b - s) OVER o AS cvd, sum(pb + ps) OVER t AS p60, sum(sb + ss) OVER t AS s60, sum(lq) OVER t AS liq60,
    list(oi_now) OVER d AS lo, list(funding_now) OVER d AS lf FROM lake WINDOW o AS (PARTITION BY symbol ORDER BY ts_us), t AS (PARTITION BY symbol ORDER BY ts_us RANGE BETWEEN {HOUR - 1} PRECEDING AND CURRENT ROW),
    d AS (PARTITION BY symbol ORDER BY ts_us RANGE BETWEEN {30 * DAY - 1} PRECEDING AND CURRENT ROW))
  SELECT symbol, ts_us, {r('CASE WHEN pc > 0 THEN power(ln(close / pc), 2) ELSE 0 END', 'rv_15m')}, {r('cvd', 'cvd_perp_15m', 3)}, {r('p60 / CASE WHEN p60 + s60 = 0 THEN 1e-9 ELSE p60 + s60 END', 'perp_share_60m')}, {r('liq60', 'liq_notional_60m')},
    {r('len(list_filter(lo, lambda x: x <= oi_now)) / len(lo)', 'oi_pctile_30d')}, {r('len(list_filter(lf, lambda x: x <= funding_now)) / len(lf)', 'funding_pctile_30d')}, {r('CASE WHEN sb + ss > 0 THEN sb / (sb + ss) ELSE 0 END', 'spot_taker_ratio')} FROM w"""
)
def composed_measures(spark, sf):
    d = compose_measures(build_bars(_sources(spark, sf), TICKS, HOUR), TICKS)
    names = ["rv_15m", "cvd_perp_15m", "perp_share_60m", "liq_notional_60m", "oi_pctile_30d", "funding_pctile_30d", "spot_taker_ratio"]
    return out(taker_ratio(d), "symbol", "ts", *names, cvd_perp_15m=3)


@entry(
    f"""WITH {SQL_BARS}, d AS (SELECT strftime(make_timestamp(ts_us), '%Y-%m-%d') AS day, close FROM bars) SELECT day, count(*) AS n, {r('sum(close)', 'total', 3)}, CAST(7 AS INTEGER) AS cols, 1 AS hashed FROM d GROUP BY 1"""
)
def daily_lake_roundtrip(spark, sf):
    """Write a day-partitioned lake, list it through its manifest and read it back."""
    path = scratch_path(spark, "lake")
    lake.write_daily(bars(spark, sf), path)
    manifest = lake.build_manifest(spark, path)
    day = F.concat_ws("-", "y", "m", "d")
    sums = spark.read.option("basePath", path).schema("close double, y string, m string, d string").parquet(path).groupBy(day.alias("day")).agg(F.sum("close").alias("total"))
    d = manifest.groupBy(day.alias("day"), "cols").agg(F.sum("rows").alias("n"), F.min((F.length("sha256") == 64).cast("int")).alias("hashed"))
    return out(d.join(sums, "day"), "day", "n", "total", "cols", "hashed", total=3)


@entry(
    f"""WITH {SQL_BARS}, m AS (SELECT symbol, quantile_cont(close, 0.5) AS med FROM bars GROUP BY 1)
  SELECT symbol, ts_us, row_number() OVER (PARTITION BY symbol ORDER BY ts_us) - 1 AS pos, {r('med', 'med')} FROM bars JOIN m USING (symbol)"""
)
def refreshed_lake(spark, sf):
    """Positions and medians of a lake read again after another session has added days to it."""
    path, late = scratch_path(spark, "lake"), scratch_path(spark, "late")
    b, cut = bars(spark, sf), F.lit("2024-01-16").cast("timestamp")
    lake.write_daily(b.where(F.col("ts") < cut), path)
    b.where(F.col("ts") >= cut).write.parquet(late)
    axis = BARS.with_(chunk_rows=64, bucket_us=DAY)

    def statistics():
        now = lake.scan(spark, path)
        med = exact_quantiles(now, ["symbol"], "close", [0.5]).select("symbol", F.col("quantile").alias("med"))
        return with_position(now.select("symbol", "ts", "close"), axis).join(med, "symbol")

    statistics().count()
    other = spark.newSession()
    apply_settings(other)
    lake.append_rows(other, other.read.parquet(late), path, ["symbol"])
    return out(statistics(), "symbol", "ts", "pos", "med")


@entry(f"WITH {SQL_BARS} SELECT symbol, count(*) AS n, {r('sum(volume)', 'volume')} FROM bars WHERE ts_us >= epoch_us(TIMESTAMP '2024-01-10') AND ts_us < epoch_us(TIMESTAMP '2024-01-13 12:00:00') GROUP BY 1")
def pruned_day_scan(spark, sf):
    path = scratch_path(spark, "lake")
    lake.write_daily(bars(spark, sf), path)
    d = lake.scan_days(spark, path, "2024-01-10 00:00:00", "2024-01-13 12:00:00", ["symbol", "volume"])
    return out(d.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume")), "symbol", "n", "volume")


@entry(
    f"""WITH {SQL_BARS}, {SQL_POLICY} SELECT strftime(make_timestamp(ts_us), '%Y-%m-%d') AS date, symbol, count(*) AS n, {r('sum(size)', 'size')} FROM dec GROUP BY 1, 2"""
)
def decision_sink(spark, sf):
    path = scratch_path(spark, "decisions")
    d = policy.ev_decision(policy_rows(spark, sf))
    d = d.withColumns({"EV_bps": F.col("EV") * 1e4, "k_atr": F.lit(1.0), "tau_long": F.lit(0.55), "tau_short": F.lit(0.55)})
    lake.write_decisions(d, path)
    back = spark.read.parquet(path).withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    return out(back.groupBy("date", "symbol").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")), "date", "symbol", "n", "size")


@entry("SELECT event_type, count(*) AS n, CAST(sum(CASE WHEN event_id % 100 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS parsed FROM events GROUP BY 1")
def jsonl_events(spark, sf):
    path = scratch_path(spark, "events")
    t = ticks(spark, sf)
    text = F.when(F.col("event_id") % 100 == 0, F.concat(F.lit("{broken "), "symbol")).otherwise(F.to_json(F.struct("symbol", F.col("value").alias("t_nn_ms"))))
    t.select(text.alias("value")).write.text(path)
    good, bad = lake.read_events(spark, path)
    name = F.regexp_extract("_corrupt", r"broken (\w+)", 1)
    d = good.select("symbol", F.lit(1).alias("ok")).unionByName(bad.select(name.alias("symbol"), F.lit(0).alias("ok")))
    return d.groupBy(F.col("symbol").alias("event_type")).agg(F.count(F.lit(1)).alias("n"), F.sum("ok").alias("parsed"))


@entry(
    f"""WITH d AS (SELECT DISTINCT o_orderpriority AS p, CAST(o_orderdate AS DATE) AS day FROM orders), i AS (SELECT p, day, day - CAST(row_number() OVER (PARTITION BY p ORDER BY day) AS INTEGER) AS g FROM d)
  SELECT p, CAST(min(day) AS VARCHAR) AS "start", CAST(max(day) + 1 AS VARCHAR) AS "end", CAST(count(*) AS INTEGER) AS days FROM i GROUP BY p, g"""
)
def day_islands(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("p"), F.col("o_orderdate").alias("day"))
    d = lake.islands(o, ["p"])
    return d.select("p", F.col("start").cast("string").alias("start"), F.col("end").cast("string").alias("end"), "days")


@entry(
    """WITH o AS (SELECT o_orderpriority AS p, CAST(o_orderdate AS DATE) AS day FROM orders), m AS (SELECT min(day) AS a, max(day) AS b FROM o),
  c AS (SELECT p, b, CAST(unnest(range(a, b + 1, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT DISTINCT p FROM o), m)
  SELECT p, CAST(day AS VARCHAR) AS day FROM c WHERE (p, day) NOT IN (SELECT (p, day) FROM o) OR day > b - 5"""
)
def incremental_day_plan(spark, sf):
    """The days each priority still lacks, over the whole time of the table, and the newest five again."""
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("p"), F.to_date("o_orderdate").alias("day"))
    first, last = o.agg(F.min("day").cast("string"), F.max("day").cast("string")).first()
    plans = None
    for p in [x["p"] for x in o.select("p").distinct().orderBy("p").collect()]:  # five
        plan = lake.plan_days(lake.day_range(spark, first, last), o.where(F.col("p") == p).select("day").distinct(), 5)
        plan = plan.select(F.lit(p).alias("p"), F.col("day").cast("string").alias("day"))
        plans = plan if plans is None else plans.unionByName(plan)
    return plans


@entry(
    """WITH s AS (SELECT o_orderpriority AS p, min(o_orderdate) AS a, max(o_orderdate) + INTERVAL 1 DAY AS b FROM orders GROUP BY 1), x AS (SELECT p, b, unnest(range(a, b, INTERVAL 30 DAY)) AS t FROM s)
  SELECT p, epoch_us(t) AS slice_start, epoch_us(least(t + INTERVAL 30 DAY, b)) AS slice_end FROM x"""
)
def time_slices(spark, sf):
    o = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("p"))
    s = o.agg(F.min(F.col("o_orderdate").cast("timestamp")).alias("a"), (F.max(F.col("o_orderdate").cast("timestamp")) + F.expr("INTERVAL 1 DAY")).alias("b"))
    return out(lake.time_slices(s, "a", "b"), "p", "slice_start", "slice_end")


def _event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    e = jobs.read_landing(spark, sf, schema, glob="events.parquet")
    return e.select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), "value", "user_id", "event_id", "props")


def _landed(spark, sdf, partition_by=None):
    """Run a stream over what is there and read its output table."""
    path = scratch_path(spark, "stream")
    jobs.run_to_path(sdf, path, scratch_path(spark, "progress"), partition_by).awaitTermination()
    return spark.read.schema(sdf.schema).parquet(path)


@entry(
    f"""WITH {SQL_TICKS}, b AS (SELECT symbol, ((us + {H - 1}) // {H}) * {H} AS bar_us, arg_min(value, (us, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (us, event_id)) AS close, CAST(sum(user_id) AS DOUBLE) AS volume FROM ticks GROUP BY 1, 2)
  SELECT symbol, bar_us, {r('open', 'open')}, {r('high', 'high')}, {r('low', 'low')}, {r('close', 'close')}, volume FROM b WHERE bar_us <= (SELECT max(bar_us) FROM b) - {2 * HOUR}"""
)
def streamed_bars(spark, sf):
    d = jobs.stream_ohlcv(_event_stream(spark, sf), TICKS, HOUR, "value", "user_id", "2 hours")
    d = _landed(spark, d).withColumn("bar_us", micros("bar"))
    return out(d, "symbol", "bar_us", "open", "high", "low", "close", "volume")


@entry("SELECT substr(sha256(event_type || '|' || user_id), 1, 16) AS decision_id FROM events GROUP BY event_type, user_id")
def streamed_idempotent(spark, sf):
    e = _event_stream(spark, sf).select("ts", decision_id("symbol", F.col("user_id").cast("string")).alias("decision_id"))
    return _landed(spark, jobs.idempotent(e, ["decision_id"], "ts", "60 days").select("decision_id"))


SQL_LINES = f"""
tele AS (SELECT symbol, us, event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE floor(value) END AS t, CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id % 101 END AS u FROM ticks),
tele2 AS (SELECT *, coalesce(last_value(t IGNORE NULLS) OVER w, 50) AS temp, coalesce(last_value(u IGNORE NULLS) OVER w, 0) AS util FROM tele WINDOW w AS (PARTITION BY symbol ORDER BY us, event_id)),
tele3 AS (SELECT *, CAST(temp >= 70 OR util >= 80 AS INTEGER) AS throttle FROM tele2)"""


def _lines(t):
    temp = F.when(F.col("event_id") % 4 != 0, F.concat(F.lit("GPU@"), F.floor("value").cast("string"), F.lit("C")))
    load = F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("GR3D "), (F.col("user_id") % 101).cast("string"), F.lit("%")))
    return t.select("symbol", "ts", "event_id", F.concat_ws(" ", F.lit("RAM x/y CPU@12C".replace("CPU@12C", "")), temp, load).alias("line"))


TELE_OUT = f"""WITH {SQL_TICKS}, {SQL_LINES} SELECT symbol, event_id, CAST(temp AS DOUBLE) AS temp, CAST(util AS DOUBLE) AS util, throttle,
  CAST(throttle <> lag(throttle, 1, 0) OVER (PARTITION BY symbol ORDER BY us, event_id) AS INTEGER) AS transition FROM tele3"""


@entry(TELE_OUT)
def telemetry_batch(spark, sf):
    d = states.parse_telemetry(_lines(ticks(spark, sf)))
    d = run_states(d, TICKS, *states.telemetry_runner())
    return out(d, "symbol", "event_id", "temp", "util", "throttle", "transition")


@entry(TELE_OUT)
def streamed_telemetry(spark, sf):
    d = states.parse_telemetry(_lines(_event_stream(spark, sf)))
    d = _landed(spark, states.stream_states(d, ["symbol"], "ts", *states.telemetry_runner(), ties=("event_id",)))
    return out(d, "symbol", "event_id", "temp", "util", "throttle", "transition")


def _in_turns(spark, rows, run, turns=3):
    """Land ``rows`` in ``turns`` parts, later parts holding rows up to two hours older than the newest before them, and run
    the stream after each, from where it stopped."""
    path = scratch_path(spark, "turns")
    lo, hi = rows.agg(F.min(micros("ts")), F.max(micros("ts"))).first()
    shaken = micros("ts") + F.pmod(F.xxhash64("event_id"), F.lit(2 * HOUR))
    turn = F.least(F.floor((shaken - lo) * turns / F.lit(hi - lo + 1)), F.lit(turns - 1))
    for k in range(turns):
        rows.where(turn == k).write.mode("append").parquet(path)
        run(jobs.read_landing(spark, path, rows.schema, max_bytes=64 << 30)).awaitTermination()


@entry(
    f"""WITH {SQL_TICKS}, x AS (SELECT *, CASE WHEN value > 30 THEN value END AS v FROM ticks), f AS (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY us, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS fl FROM x)
  SELECT symbol, event_id, {r('fl', 'v_filled')}, CAST(v IS NULL AND fl IS NOT NULL AS INTEGER) AS v_imputed FROM f WHERE us // 1000 <= (SELECT max(us) // 1000 FROM ticks) - {3 * HOUR // 1000}"""
)
def streamed_ffill(spark, sf):
    """Rows come in three parts and out of order; they wait for the watermark and fill as in a batch."""
    e = ticks(spark, sf).select("symbol", "ts", "event_id", F.when(F.col("value") > 30, F.col("value")).alias("v"))
    path, progress = scratch_path(spark, "stream"), scratch_path(spark, "progress")
    filled = lambda sdf: states.stream_ffill(sdf, ["symbol"], "ts", ["v"], delay="3 hours", ties=("event_id",))
    _in_turns(spark, e, lambda sdf: jobs.run_to_path(filled(sdf), path, progress))
    return out(spark.read.parquet(path), "symbol", "event_id", "v_filled", "v_imputed")


@entry(
    """WITH q AS (SELECT user_id AS id, arg_max(CASE WHEN event_type = 'purchase' THEN 'done' ELSE 'queued' END, ts) AS state FROM events GROUP BY 1)
  SELECT c_custkey AS decision_id, coalesce(state, 'not_found') AS state FROM customer LEFT JOIN q ON id = c_custkey"""
)
def streamed_queue(spark, sf):
    """The work queue kept by a stream, batch by batch; one batch is handed in twice."""
    ev = ticks(spark, sf).select("event_id", F.col("user_id").alias("decision_id"), F.when(F.col("symbol") == "purchase", "done").otherwise("queued").alias("state"), "ts")
    path, progress = scratch_path(spark, "queue"), scratch_path(spark, "progress")
    sink = jobs.queue_sink(path)

    def twice(batch, number):
        sink(batch, number)
        sink(batch, number)

    _in_turns(spark, ev, lambda sdf: jobs.run_batches(sdf, twice, progress))
    ids = table(spark, sf, "customer").select(F.col("c_custkey").alias("decision_id"))
    return jobs.lookup_states(ids, jobs.read_queue(spark, path))


@entry(
    f"""WITH {SQL_TICKS}, w AS (SELECT unnest([0, 1, 2]) AS i), x AS (SELECT (us // {2 * HOUR}) * {2 * HOUR} - i * {2 * HOUR} AS s, value FROM ticks, w), m AS (SELECT max(us) AS mx FROM ticks)
  SELECT s AS start_us, count(*) AS n, {r('quantile_disc(value, 0.5)', 'p50')}, {r('quantile_disc(value, 0.99)', 'p99')} FROM x, m WHERE s + {6 * HOUR} <= mx - {6 * HOUR} GROUP BY 1"""
)
def streamed_latency(spark, sf):
    e = _event_stream(spark, sf).select("ts", F.col("value").alias("t_nn_ms"))
    d = jobs.latency_quantiles(_landed(spark, jobs.stream_latency(e, "ts", ["t_nn_ms"], "6 hours", "2 hours", "6 hours")))
    return out(d.select(micros("start").alias("start_us"), "n", "p50", "p99"), "start_us", "n", "p50", "p99")


def _predict(x: np.ndarray) -> np.ndarray:
    up = 0.3 + 0.4 * (x[:, -1, 0] > x[:, 0, 0])
    return np.stack([np.zeros(len(x)), up, 0.9 - up], axis=1)


def _live_inputs(spark, sf):
    d = policy_rows(spark, sf).select("symbol", "ts", "high", "low", "close", "volume", "atr_pct", "vol_pctile", "liq60_pctile")
    path = scratch_path(spark, "livebars")
    d.write.parquet(path)
    return spark.read.parquet(path), path


LIVE_SQL = f"""WITH RECURSIVE {SQL_BARS}, {SQL_POLICY},
  p0 AS (SELECT *, 0.3 + 0.4 * CAST(close > lag(close, 7) OVER (PARTITION BY symbol ORDER BY ts_us) AS INTEGER) AS q, row_number() OVER (PARTITION BY symbol ORDER BY ts_us) AS n FROM pol1),
  p1 AS (SELECT *, CAST(q AS DOUBLE) AS a, CAST(0.9 AS DOUBLE) - CAST(q AS DOUBLE) AS b FROM p0 WHERE n >= 8),
  p2 AS (SELECT *, a * w - (1 - a) * w - (0.5 + 0.3 + 0.4 * liq) / 1e4 AS l2, b * w - (1 - b) * w - (0.5 + 0.3 + 0.4 * liq) / 1e4 AS s2 FROM p1),
  c AS MATERIALIZED (SELECT symbol, ts_us, row_number() OVER (PARTITION BY symbol ORDER BY ts_us) AS rn, high, low, close, CASE WHEN l2 >= s2 THEN 'LONG' ELSE 'SHORT' END AS want_side,
    CASE WHEN l2 >= s2 THEN close * (1 + w) ELSE close * (1 - w) END AS tp, CASE WHEN l2 >= s2 THEN close * (1 - w) ELSE close * (1 + w) END AS sl,
    CASE WHEN greatest(a, b) < 0.55 THEN 'TAU' WHEN greatest(l2, s2) <= 0 THEN 'EV≤0' ELSE 'ENTER' END AS want FROM p2),
  run AS (
    SELECT symbol, CAST(0 AS BIGINT) AS rn, CAST(NULL AS VARCHAR) AS side, CAST(NULL AS DOUBLE) AS tp, CAST(NULL AS DOUBLE) AS sl, CAST(NULL AS BIGINT) AS eu, '' AS reason FROM c WHERE rn = 1
    UNION ALL
    SELECT symbol, rn, CASE WHEN reason = 'ENTER' THEN want_side WHEN reason = 'OVERLAP' THEN side END, CASE WHEN reason = 'ENTER' THEN ntp ELSE tp END, CASE WHEN reason = 'ENTER' THEN nsl ELSE sl END, CASE WHEN reason = 'ENTER' THEN ts_us ELSE eu END, reason
    FROM (SELECT c.symbol, c.rn, c.ts_us, c.want_side, c.tp AS ntp, c.sl AS nsl, r.side, r.tp, r.sl, r.eu,
        CASE WHEN r.side IS NOT NULL THEN CASE WHEN (r.side = 'LONG' AND c.low <= r.sl) OR (r.side = 'SHORT' AND c.high >= r.sl) THEN 'EXIT_SL' WHEN (r.side = 'LONG' AND c.high >= r.tp) OR (r.side = 'SHORT' AND c.low <= r.tp) THEN 'EXIT_TP' ELSE 'OVERLAP' END
        WHEN r.eu IS NOT NULL AND c.ts_us - r.eu < 12 * {H} THEN 'COOLDOWN' ELSE c.want END AS reason
      FROM run r JOIN c ON c.symbol = r.symbol AND c.rn = r.rn + 1) q)
  SELECT c.symbol, ts_us, reason, CASE WHEN reason = 'ENTER' THEN want_side ELSE 'WAIT' END AS side FROM c JOIN run USING (symbol, rn)"""


@entry(LIVE_SQL)
def streamed_decisions(spark, sf):
    """Bars landing as files -> window state -> scorer -> position policy state -> decision table."""
    static, path = _live_inputs(spark, sf)
    stream = jobs.read_landing(spark, path, static.schema)
    d = jobs.live_decisions(stream, _predict, ["close", "volume"], 8, every=HOUR, H=12)
    return out(_landed(spark, d), "symbol", "ts", "reason", "side")


@entry(
    """WITH q AS (SELECT user_id AS id, arg_max(CASE WHEN event_type = 'purchase' THEN 'done' ELSE 'queued' END, ts) AS state FROM events GROUP BY 1)
  SELECT c_custkey AS decision_id, coalesce(state, 'not_found') AS state FROM customer LEFT JOIN q ON id = c_custkey"""
)
def explain_queue(spark, sf):
    e = table(spark, sf, "events")
    ev = e.select(F.col("user_id").alias("decision_id"), F.when(F.col("event_type") == "purchase", "done").otherwise("queued").alias("state"), "ts")
    ids = table(spark, sf, "customer").select(F.col("c_custkey").alias("decision_id"))
    return jobs.lookup_states(ids, ev)


@entry(f"WITH {SQL_BARS} SELECT count(*) AS n, min(ts_us) AS min_ts, max(ts_us) AS max_ts FROM bars")
def lake_view(spark, sf):
    d = lake.named_view(bars(spark, sf), "tsforge_bars")
    return out(d, "n", "min_ts", "max_ts")
