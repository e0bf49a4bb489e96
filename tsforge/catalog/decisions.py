"""Features, decisions, monitoring and explanation."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tsforge.catalog import Registry
from tsforge.catalog.data import BARS, H, SQL_BARS, SQL_DAILY, SQL_TICKS, DAILY, bars, daily, out, r, table, ticks
from tsforge.catalog.statistics import ATR, RET, W
from tsforge.functions import scalars
from tsforge.functions.timeunits import DAY, HOUR, micros
from tsforge.operators import quality
from tsforge.operators import causal, explain, monitor, policy, quality, ranks
from tsforge.plans import features as feature_plan
from tsforge.session import cut_lineage

ENTRIES = Registry()
entry = ENTRIES.entry


def measured_bars(spark, sf):
    """Bars with the measures a feature build expects, derived from price and volume."""
    b = bars(spark, sf)
    v = F.col("volume")
    d = b.withColumns(
        {
            "funding_now": F.when(v % 3 != 0, F.col("close") / 100),
            "oi_now": F.when(v % 5 != 0, v * 10 + F.col("open")),
            "funding_pctile_30d": (v % 11) / 11,
            "cvd_perp_5m": v * 2 - F.col("close"),
            "perp_share_60m": (v % 7) / 7,
            "liq_notional_60m": F.col("high") * 3,
            "rv_5m": F.col("low") / F.col("high"),
        }
    )
    return d


CUT_ROWS = 96  # chunks far smaller than a series, so these queries run the plan of long series
FW = 96
P = f"OVER ({W} ROWS BETWEEN {FW} PRECEDING AND 1 PRECEDING)"


def _wz(cols: dict[str, str]) -> str:
    """Two CTEs: winsorised inputs, then z-scores of them."""
    clip = ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, coalesce(quantile_cont({c}, 0.01) {P}, {c})), coalesce(quantile_cont({c}, 0.99) {P}, {c})) END AS w_{c}" for c in cols
    )
    z = ", ".join(
        f"CASE WHEN stddev_pop(w_{c}) {P} >= 1e-12 THEN (lag(w_{c}) OVER ({W}) - avg(w_{c}) {P}) / stddev_pop(w_{c}) {P} WHEN lag(w_{c}) OVER ({W}) IS NOT NULL THEN 0 END AS {name}" for c, name in cols.items()
    )
    return f"f3 AS (SELECT *, {clip} FROM f2), f4 AS (SELECT *, {z}, row_number() OVER ({W}) - 1 AS pos FROM f3)"


FEATURE_SQL = f"""
f0 AS (SELECT *, CASE WHEN volume % 3 <> 0 THEN close / 100 END AS funding_now, CASE WHEN volume % 5 <> 0 THEN volume * 10 + open END AS oi_now,
  volume * 2 - close AS cvd, {RET} AS ret_5m FROM bars),
f1 AS (SELECT *, last_value(funding_now IGNORE NULLS) OVER ({W} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS fund,
  last_value(oi_now IGNORE NULLS) OVER ({W} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS oi FROM f0),
f2 AS (SELECT *, ln(1 + volume) AS i_vol, ln(1 + oi) AS i_oi, fund AS i_fund, cvd - lag(cvd) OVER ({W}) AS i_cvd, ln(1 + high * 3) AS i_liq, low / high AS i_rv,
  sum(ret_5m) OVER ({W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS ret_1h, sum(ret_5m) OVER ({W} ROWS BETWEEN 47 PRECEDING AND CURRENT ROW) AS ret_4h,
  2 * pi() * ((CAST(isodow(make_timestamp(ts_us)) AS INTEGER) - 1) * 24 + hour(make_timestamp(ts_us))) / 168.0 AS ang FROM f1),
{_wz({'i_vol': 'vol_z', 'i_oi': 'oi_z', 'i_fund': 'fund_now_z', 'i_cvd': 'cvd_diff_z', 'i_liq': 'liq60_z', 'i_rv': 'rv_5m_z'})}"""

EXPRS = {
    "ret_5m": "ret_5m",
    "ret_1h": "ret_1h",
    "ret_4h": "ret_4h",
    "hl_range": "(high - low) / close",
    "co_ret": "ln(close / open)",
    "vol_z": "vol_z",
    "oi_z": "oi_z",
    "fund_now_z": "fund_now_z",
    "funding_pctile_30d": "(volume % 11) / 11",
    "cvd_perp_5m": "cvd",
    "cvd_diff_z": "cvd_diff_z",
    "perp_share_60m": "(volume % 7) / 7",
    "liq60_z": "liq60_z",
    "rv_5m_z": "rv_5m_z",
    "hour_of_week_sin": "sin(ang)",
    "hour_of_week_cos": "cos(ang)",
}


@entry(
    f"""WITH {SQL_BARS}, {FEATURE_SQL} SELECT symbol, ts_us, {', '.join(r(f'coalesce({e}, 0)', n, 5) for n, e in EXPRS.items())},
  CAST(funding_now IS NULL AND fund IS NOT NULL AS INTEGER) AS _imputed_funding_now, CAST(oi_now IS NULL AND oi IS NOT NULL AS INTEGER) AS _imputed_oi_now FROM f4 WHERE pos >= {FW}"""
)
def feature_build(spark, sf):
    d = feature_plan.build_features(measured_bars(spark, sf), BARS, warmup=FW)
    return out(d, "symbol", "ts", *feature_plan.FEATURES, *feature_plan.FLAGS, **dict.fromkeys(feature_plan.FEATURES, 5))


@entry(
    f"""WITH {SQL_BARS}, {FEATURE_SQL}, l AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts_us DESC) AS rn FROM f4)
  SELECT symbol, ts_us, {', '.join(r(f'coalesce({e}, 0)', n, 5) for n, e in EXPRS.items())} FROM l WHERE rn = 1"""
)
def latest_features(spark, sf):
    d = feature_plan.latest_features(measured_bars(spark, sf), BARS, window=FW)
    return out(d, "symbol", "ts", *feature_plan.FEATURES, **dict.fromkeys(feature_plan.FEATURES, 5))


def policy_rows(spark, sf):
    """Bars with ATR%, probabilities and percentiles derived from the volume."""
    d = cut_lineage(causal.atr_pct(bars(spark, sf), BARS, 14))
    d = ranks.pct_rank(d, ["symbol"], "atr_pct", "vol_pctile")
    v = F.col("volume")
    d = d.withColumns({"p_long": ((v * 7) % 101) / 125.0, "p_short": ((v * 13) % 89) / 110.0, "liq60_pctile": (v % 50) / 50.0})
    return d.withColumn("p_wait", F.greatest(F.lit(0.0), 1 - F.col("p_long") - F.col("p_short")))


SQL_POLICY = f"""{ATR},
pol0 AS (SELECT *, (rank() OVER (PARTITION BY symbol ORDER BY atr_pct) + (count(*) OVER (PARTITION BY symbol, atr_pct) - 1) / 2) / count(*) OVER (PARTITION BY symbol) AS vol_pctile,
  ((volume * 7) % 101) / 125.0 AS pl, ((volume * 13) % 89) / 110.0 AS ps, (volume % 50) / 50.0 AS liq FROM atr),
pol1 AS (SELECT *, (1 + 0.5 * vol_pctile) AS k, (1 + 0.5 * vol_pctile) * atr_pct AS w FROM pol0),
pol AS (SELECT *, pl * w - (1 - pl) * w - 0.0005 AS el, ps * w - (1 - ps) * w - 0.0005 AS es FROM pol1),
ev AS (SELECT *, CASE WHEN greatest(el, es) <= 0 THEN 'WAIT' WHEN el >= es THEN 'LONG' ELSE 'SHORT' END AS side, row_number() OVER ({W}) AS rn FROM pol),
dec AS (SELECT *, CASE WHEN side = 'WAIT' THEN 0 ELSE least(greatest(greatest(pl, ps), 0.2), 1) END AS size,
  CASE side WHEN 'LONG' THEN close * (1 + w) WHEN 'SHORT' THEN close * (1 - w) END AS tp, CASE side WHEN 'LONG' THEN close * (1 - w) WHEN 'SHORT' THEN close * (1 + w) END AS sl,
  CASE WHEN side = 'WAIT' THEN 0 ELSE greatest(el, es) END AS e FROM ev)"""

DEC_OUT = f"{r('size', 'size')}, {r('tp', 'TP_px', 4)}, {r('sl', 'SL_px', 4)}, {r('e', 'EV')}"


@entry(f"WITH {SQL_BARS}, {SQL_POLICY} SELECT symbol, ts_us, side, {DEC_OUT}, CASE WHEN side = 'WAIT' THEN 'ev<=0' ELSE 'enter' END AS reason FROM dec")
def ev_decisions(spark, sf):
    d = policy.ev_decision(policy_rows(spark, sf))
    return out(d, "symbol", "ts", "side", "size", "TP_px", "SL_px", "EV", "reason", TP_px=4, SL_px=4)


@entry(
    f"""WITH RECURSIVE {SQL_BARS}, {SQL_POLICY},
  c AS MATERIALIZED (SELECT symbol, ts_us, close, side, tp, sl, size, e, rn FROM dec),
  run AS (
    SELECT symbol, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS eu, CAST(NULL AS VARCHAR) AS es, CAST(NULL AS DOUBLE) AS ec, CAST(NULL AS DOUBLE) AS et, CAST(NULL AS DOUBLE) AS hi, CAST(NULL AS DOUBLE) AS lo, FALSE AS mk, '' AS why FROM c WHERE rn = 1
    UNION ALL
    SELECT symbol, rn, CASE WHEN cool OR side = 'WAIT' THEN eu ELSE ts_us END, CASE WHEN cool OR side = 'WAIT' THEN es ELSE side END,
      CASE WHEN cool OR side = 'WAIT' THEN ec ELSE close END, CASE WHEN cool OR side = 'WAIT' THEN et ELSE tp END,
      CASE WHEN cool THEN nhi WHEN side = 'WAIT' THEN hi ELSE close END, CASE WHEN cool THEN nlo WHEN side = 'WAIT' THEN lo ELSE close END,
      CASE WHEN cool THEN mk OR age = 3 WHEN side = 'WAIT' THEN mk ELSE FALSE END,
      CASE WHEN NOT cool THEN '' WHEN age = 3 AND NOT mk AND CASE WHEN es = 'LONG' THEN et - ec ELSE ec - et END > 0
        AND greatest(0, CASE WHEN es = 'LONG' THEN nhi - ec ELSE ec - nlo END) < 0.1 * CASE WHEN es = 'LONG' THEN et - ec ELSE ec - et END THEN 'early_exit' ELSE 'cooldown' END
    FROM (SELECT c.symbol, c.rn, c.ts_us, c.close, c.side, c.tp, r.eu, r.es, r.ec, r.et, r.hi, r.lo, r.mk,
        coalesce(c.ts_us - r.eu < 12 * {H}, FALSE) AS cool, (c.ts_us - r.eu) // {H} AS age,
        CASE WHEN (c.ts_us - r.eu) // {H} BETWEEN 1 AND 3 THEN greatest(r.hi, c.close) ELSE r.hi END AS nhi,
        CASE WHEN (c.ts_us - r.eu) // {H} BETWEEN 1 AND 3 THEN least(r.lo, c.close) ELSE r.lo END AS nlo
      FROM run r JOIN c ON c.symbol = r.symbol AND c.rn = r.rn + 1) q)
  SELECT c.symbol, ts_us, CASE WHEN why = '' THEN side ELSE 'WAIT' END AS side, {r("CASE WHEN why = '' THEN size ELSE 0 END", 'size')}, {r("CASE WHEN why = '' THEN tp END", 'TP_px', 4)}, {r("CASE WHEN why = '' THEN sl END", 'SL_px', 4)},
    {r("CASE WHEN why = '' THEN e ELSE 0 END", 'EV')}, CASE WHEN why <> '' THEN why WHEN side = 'WAIT' THEN 'ev<=0' ELSE 'enter' END AS reason
  FROM c JOIN run USING (symbol, rn)"""
)
def cooldown_decisions(spark, sf):
    d = cut_lineage(policy.ev_decision(policy_rows(spark, sf)))
    d = policy.cooldown_policy(d, BARS, H=12, every=HOUR)
    return out(d, "symbol", "ts", "side", "size", "TP_px", "SL_px", "EV", "reason", TP_px=4, SL_px=4)


@entry(ENTRIES["cooldown_decisions"][1])
def cooldown_in_chunks(spark, sf):
    """The same decisions by the plan of long series: pointers between chunks."""
    d = cut_lineage(policy.ev_decision(policy_rows(spark, sf)))
    d = policy.cooldown_policy(d, BARS.with_(chunk_rows=CUT_ROWS), H=12, every=HOUR)
    return out(d, "symbol", "ts", "side", "size", "TP_px", "SL_px", "EV", "reason", TP_px=4, SL_px=4)


def _position_sql(early: bool, tau: float | None = None) -> str:
    shown = "" if tau is None else f", CAST({tau} AS DOUBLE) AS tau_long"
    gone = "WHEN r.bars + 1 >= 3 AND greatest(0, CASE WHEN r.side = 'LONG' THEN c.close - r.ec ELSE r.ec - c.close END) <= 0 THEN 'EARLY_EXIT_NO_FT'" if early else ""
    return f"""WITH RECURSIVE {SQL_BARS}, {SQL_POLICY},
  p1 AS (SELECT *, pl * w - (1 - pl) * w - (0.5 + 0.3 + 0.4 * liq) / 1e4 AS l2, ps * w - (1 - ps) * w - (0.5 + 0.3 + 0.4 * liq) / 1e4 AS s2 FROM ev),
  c AS MATERIALIZED (SELECT symbol, ts_us, rn, high, low, close, k, vol_pctile, liq, pl, ps, greatest(l2, s2) AS ev2, CASE WHEN l2 >= s2 THEN 'LONG' ELSE 'SHORT' END AS want_side,
    CASE WHEN l2 >= s2 THEN close * (1 + w) ELSE close * (1 - w) END AS tp, CASE WHEN l2 >= s2 THEN close * (1 - w) ELSE close * (1 + w) END AS sl,
    CASE WHEN greatest(pl, ps) < 0.55 THEN 'TAU' WHEN greatest(l2, s2) <= 0 THEN 'EV≤0' ELSE 'ENTER' END AS want FROM p1),
  run AS (
    SELECT symbol, CAST(0 AS BIGINT) AS rn, CAST(NULL AS VARCHAR) AS side, CAST(NULL AS DOUBLE) AS ec, CAST(NULL AS DOUBLE) AS tp, CAST(NULL AS DOUBLE) AS sl, CAST(0 AS BIGINT) AS bars, CAST(NULL AS BIGINT) AS eu, '' AS reason FROM c WHERE rn = 1
    UNION ALL
    SELECT symbol, rn, CASE WHEN reason = 'ENTER' THEN want_side WHEN reason = 'OVERLAP' THEN side END, CASE WHEN reason = 'ENTER' THEN close ELSE ec END,
      CASE WHEN reason = 'ENTER' THEN ntp ELSE tp END, CASE WHEN reason = 'ENTER' THEN nsl ELSE sl END, CASE WHEN reason = 'OVERLAP' THEN bars + 1 ELSE 0 END,
      CASE WHEN reason = 'ENTER' THEN ts_us ELSE eu END, reason
    FROM (SELECT c.symbol, c.rn, c.ts_us, c.close, c.want_side, c.tp AS ntp, c.sl AS nsl, r.side, r.ec, r.tp, r.sl, r.bars, r.eu,
        CASE WHEN r.side IS NOT NULL THEN
          CASE WHEN (r.side = 'LONG' AND c.low <= r.sl) OR (r.side = 'SHORT' AND c.high >= r.sl) THEN 'EXIT_SL'
               WHEN (r.side = 'LONG' AND c.high >= r.tp) OR (r.side = 'SHORT' AND c.low <= r.tp) THEN 'EXIT_TP' {gone} ELSE 'OVERLAP' END
        WHEN r.eu IS NOT NULL AND c.ts_us - r.eu < 12 * {H} THEN 'COOLDOWN' ELSE c.want END AS reason
      FROM run r JOIN c ON c.symbol = r.symbol AND c.rn = r.rn + 1) q)
  SELECT c.symbol, ts_us, CASE WHEN reason = 'ENTER' THEN want_side ELSE 'WAIT' END AS side, {r("CASE WHEN reason = 'ENTER' THEN least(greatest(greatest(pl, ps), 0.2), 1) ELSE 0 END", 'size')},
    {r("CASE WHEN reason = 'ENTER' THEN c.tp WHEN reason <> 'COOLDOWN' THEN 0 END", 'TP_px', 4)}, {r("CASE WHEN reason = 'ENTER' THEN c.sl WHEN reason <> 'COOLDOWN' THEN 0 END", 'SL_px', 4)},
    {r("CASE WHEN reason IN ('ENTER', 'EV≤0') THEN ev2 * 1e4 ELSE 0 END", 'EV_bps', 3)}, {r('k', 'k_atr')}, {r('vol_pctile', 'vol_pctile')}, {r('liq', 'liq60_pctile')}, reason{shown}
  FROM c JOIN run USING (symbol, rn)"""


def _positions(spark, sf, early, axis):
    d = cut_lineage(policy_rows(spark, sf))
    d = policy.position_policy(d, axis, H=12, every=HOUR, early_exit=early)
    return out(d, "symbol", "ts", "side", "size", "TP_px", "SL_px", "EV_bps", "k_atr", "vol_pctile", "liq60_pctile", "reason", TP_px=4, SL_px=4, EV_bps=3)


@entry(_position_sql(False))
def position_decisions(spark, sf):
    return _positions(spark, sf, False, BARS)


@entry(_position_sql(True))
def position_early_exit(spark, sf):
    return _positions(spark, sf, True, BARS.with_(chunk_rows=CUT_ROWS))


@entry(
    f"""WITH {SQL_BARS}, {SQL_POLICY}, t AS (SELECT *, volume % 2 = 0 AS thr, greatest(pl, ps) < 0.55::DOUBLE + 0.05::DOUBLE AS weak FROM dec)
  SELECT symbol, ts_us, CASE WHEN thr AND weak THEN 'WAIT' ELSE side END AS side, {r('CASE WHEN thr AND weak THEN 0 ELSE size END', 'size')},
    CASE WHEN thr AND weak THEN 'throttle' WHEN side = 'WAIT' THEN 'ev<=0' ELSE 'enter' END AS reason FROM t"""
)
def throttle_cushion(spark, sf):
    d = policy.ev_decision(policy_rows(spark, sf)).withColumn("throttled", F.col("volume") % 2 == 0)
    return out(policy.throttle_cushion(d), "symbol", "ts", "side", "size", "reason")


@entry(
    f"""WITH {SQL_BARS}, {SQL_POLICY}, x AS (SELECT *, CAST(volume % 3 = 0 AS DOUBLE) AS f1, CAST(volume % 5 = 0 AS DOUBLE) AS f2 FROM dec),
  a AS (SELECT ts_us // {DAY} AS d, avg(CAST(side <> 'WAIT' AS DOUBLE)) AS v FROM x GROUP BY 1),
  m AS (SELECT avg(v) AS mu, stddev_samp(v) AS sd, arg_max(v, d) AS last FROM a)
  SELECT metric, {r('value', 'value')} FROM (
    SELECT 'impute_f1' AS metric, avg(f1) AS value FROM x UNION ALL SELECT 'impute_f2', avg(f2) FROM x
    UNION ALL SELECT 'mix_' || side, count(*) / (SELECT count(*) FROM x) FROM x GROUP BY side
    UNION ALL SELECT 'alert_mu', mu FROM m UNION ALL SELECT 'alert_sigma', sd FROM m UNION ALL SELECT 'alert_ucl', mu + 3 * sd FROM m
    UNION ALL SELECT 'alert_lcl', greatest(0, mu - 3 * sd) FROM m UNION ALL SELECT 'alert_last', last FROM m
    UNION ALL SELECT 'alert_out_of_control', CAST(last > mu + 3 * sd OR last < greatest(0, mu - 3 * sd) AS DOUBLE) FROM m UNION ALL SELECT 'ev_trade', avg(e) FROM x)"""
)
def drift_report(spark, sf):
    d = policy.ev_decision(policy_rows(spark, sf))
    d = cut_lineage(d.withColumns({"_f1": (F.col("volume") % 3 == 0).cast("int"), "_f2": (F.col("volume") % 5 == 0).cast("int")}))
    return out(monitor.drift_report(d, d, ["_f1", "_f2"]), "metric", "value")


@entry(
    """WITH d AS (SELECT o_orderpriority AS p, o_orderdate AS day, avg(CAST(o_orderstatus = 'F' AS DOUBLE)) AS v FROM orders GROUP BY 1, 2),
  m AS (SELECT p, avg(v) AS mu, stddev_samp(v) AS sd, arg_max(v, day) AS last FROM d GROUP BY 1)
  SELECT p, round(mu, 6) + 0.0 AS mu, round(sd, 6) + 0.0 AS sigma, round(mu + 3 * sd, 6) + 0.0 AS ucl, round(greatest(0, mu - 3 * sd), 6) + 0.0 AS lcl, round(last, 6) + 0.0 AS last,
    CAST(last > mu + 3 * sd OR last < greatest(0, mu - 3 * sd) AS INTEGER) AS out_of_control FROM m"""
)
def control_chart(spark, sf):
    o = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("p"), "o_orderdate")
    d = o.agg(F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("v"))
    return out(monitor.control_chart(d, "o_orderdate", "v", ["p"]), "p", "mu", "sigma", "ucl", "lcl", "last", "out_of_control")


@entry(
    f"""WITH RECURSIVE {SQL_DAILY}, s AS (SELECT symbol, avg(close) AS mu, stddev_samp(close) AS sd FROM daily GROUP BY 1),
  z AS MATERIALIZED (SELECT symbol, ts_us, (close - mu) / sd AS z, row_number() OVER ({W}) AS rn FROM daily JOIN s USING (symbol)),
  run AS (SELECT symbol, CAST(0 AS BIGINT) AS rn, CAST(0 AS DOUBLE) AS up, CAST(0 AS DOUBLE) AS dn, CAST(0 AS INTEGER) AS changed FROM z WHERE rn = 1
    UNION ALL SELECT symbol, rn, CASE WHEN u > 4.0 OR -d > 4.0 THEN 0 ELSE u END, CASE WHEN u > 4.0 OR -d > 4.0 THEN 0 ELSE d END, CAST(u > 4.0 OR -d > 4.0 AS INTEGER)
    FROM (SELECT z.symbol, z.rn, greatest(0, r.up + z.z - 0.25) AS u, least(0, r.dn + z.z + 0.25) AS d FROM run r JOIN z ON z.symbol = r.symbol AND z.rn = r.rn + 1) q)
  SELECT z.symbol, ts_us, changed, CAST(sum(changed) OVER (PARTITION BY z.symbol ORDER BY rn) AS BIGINT) AS regime_id FROM z JOIN run USING (symbol, rn)"""
)
def cusum_regimes(spark, sf):
    d = daily(spark, sf)
    h = d.select("symbol").distinct().withColumn("h", F.lit(4.0))
    return out(monitor.cusum_regimes(d, DAILY, "close", h), "symbol", "ts", "changed", "regime_id")


@entry(
    f"""WITH {SQL_DAILY}, s AS (SELECT symbol, avg(close) AS mu, stddev_samp(close) AS sd FROM daily GROUP BY 1),
  z AS MATERIALIZED (SELECT symbol, row_number() OVER ({W}) - 1 AS pos, count(*) OVER (PARTITION BY symbol) AS n, (close - mu) / sd AS z FROM daily JOIN s USING (symbol)),
  d AS (SELECT symbol, b, pos AS i, CAST('0x' || substr(md5('42|' || symbol || '|' || b || '|' || pos), 1, 15) AS BIGINT) % n AS pick FROM z, range(200) r(b)),
  x AS (SELECT d.symbol, b, i, z FROM d JOIN z ON z.symbol = d.symbol AND z.pos = pick),
  t AS (SELECT symbol, b, i, sum(z - 0.25) OVER w AS u, sum(z + 0.25) OVER w AS v FROM x WINDOW w AS (PARTITION BY symbol, b ORDER BY i)),
  e AS (SELECT symbol, b, u - least(0, min(u) OVER w) AS up, greatest(0, max(v) OVER w) - v AS dn FROM t WINDOW w AS (PARTITION BY symbol, b ORDER BY i)),
  m AS (SELECT symbol, b, max(greatest(up, dn)) AS top FROM e GROUP BY 1, 2)
  SELECT symbol, {r('quantile_cont(top, 0.99)', 'h')} FROM m GROUP BY 1"""
)
def cusum_threshold(spark, sf):
    return out(monitor.cusum_threshold(daily(spark, sf), DAILY, "close", part_rows=7), "symbol", "h")


SQL_TRIGGER = """, o AS (SELECT o_orderpriority AS symbol, o_orderdate AS day, avg(CAST(o_orderstatus = 'F' AS DOUBLE)) AS v FROM orders GROUP BY 1, 2),
  m AS (SELECT avg(v) AS mu, stddev_samp(v) AS sd, arg_max(v, day) AS last FROM o GROUP BY symbol),
  q AS (SELECT max(CAST(last > mu + 3 * sd OR last < greatest(0, mu - 3 * sd) AS INTEGER)) AS ooc FROM m)"""


@entry(
    f"""WITH {SQL_DAILY}{SQL_TRIGGER}, r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts_us DESC) AS rn FROM daily),
  c AS (SELECT lim, max(CAST(volume > lim AS INTEGER)) AS changed FROM r, (VALUES (1), (6), (1000000)) l(lim) WHERE rn <= 10 GROUP BY 1)
  SELECT CAST(lim AS INTEGER) AS lim, CASE WHEN changed = 1 THEN 'regime_shift' ELSE 'alert_rate_ooc' END AS reason FROM c, q WHERE changed = 1 OR ooc = 1"""
)
def retrain_trigger(spark, sf):
    """The trigger for three limits of a change: both reasons and none can come out."""
    d = daily(spark, sf)
    o = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("p"), "o_orderdate")
    chart = monitor.control_chart(o.agg(F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("v")), "o_orderdate", "v", ["p"])
    parts = []
    for lim in (1, 6, 1_000_000):
        regimes = d.select("symbol", "ts", (F.col("volume") > lim).cast("int").alias("changed"))
        parts.append(monitor.retrain_trigger(chart, regimes, DAILY).select(F.lit(lim).alias("lim"), "reason"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


LAT = [("all", None), ("1d", DAY), ("10d", 10 * DAY)]
NOW_US = 1706659200000000


@entry(
    f"""WITH {SQL_TICKS}, l AS (SELECT us, 't_feat_ms' AS metric, value AS v FROM ticks UNION ALL SELECT us, 't_nn_ms', CAST(user_id AS DOUBLE) FROM ticks),
  h AS (SELECT 'all' AS horizon, 0::BIGINT AS lo UNION ALL SELECT '1d', {NOW_US - DAY} UNION ALL SELECT '10d', {NOW_US - 10 * DAY})
  SELECT horizon, metric, {r('quantile_cont(v, 0.5)', 'p50')}, {r('quantile_cont(v, 0.99)', 'p99')}, count(*) AS n FROM l JOIN h ON us >= lo GROUP BY 1, 2"""
)
def latency_percentiles(spark, sf):
    t = ticks(spark, sf).select("ts", F.col("value").alias("t_feat_ms"), F.col("user_id").alias("t_nn_ms"))
    now = F.timestamp_micros(F.lit(NOW_US))
    return out(monitor.latency_report(t, "ts", ["t_feat_ms", "t_nn_ms"], now, dict(LAT)), "horizon", "metric", "p50", "p99", "n")


@entry(
    f"""WITH {SQL_TICKS}, x AS (SELECT event_id, us, value AS a, user_id % 60 AS b, value / 10 AS c FROM ticks)
  SELECT event_id, CAST(a > 20 OR b > 30 OR c > 10 AS INTEGER) AS degraded, CASE WHEN c > 10 THEN 'policy' WHEN b > 30 THEN 'nn' WHEN a > 20 THEN 'feat' END AS exceed_stage,
    {r(f'(us - (us // {H}) * {H}) / 60000000', 'delta_min', 9)} FROM x"""
)
def sla_flags(spark, sf):
    t = ticks(spark, sf)
    t = t.select(
        "event_id", "ts", F.col("value").alias("t_feat_ms"), (F.col("user_id") % 60).cast("double").alias("t_nn_ms"), (F.col("value") / 10).alias("t_policy_ms"),
        F.date_trunc("hour", "ts").alias("candle_close_ts"),
    )
    return out(monitor.sla_flags(t), "event_id", "degraded", "exceed_stage", "delta_min", delta_min=9)


SQL_PARITY = """p AS (SELECT count(*) AS n, avg((power(q - q * 1.01, 2) + power(t - d, 2)) / 2) AS mse
  FROM (SELECT sum(l_quantity) AS q, sum(l_tax) AS t, sum(l_discount) AS d FROM lineitem GROUP BY l_orderkey, l_linenumber))"""


def _score_errors(spark, sf):
    """Squared differences of two tables made of every order line, by order and line number."""
    keys = ["l_orderkey", "l_linenumber"]
    one = table(spark, sf, "lineitem").groupBy(*keys).agg(F.sum("l_quantity").alias("q"), F.sum("l_tax").alias("t"), F.sum("l_discount").alias("d"))
    a = one.select(*keys, F.col("q").alias("x"), F.col("t").alias("y"))
    return monitor.table_mse(a, one.select(*keys, (F.col("q") * 1.01).alias("x"), F.col("d").alias("y")), keys, ["x", "y"])


@entry(f"WITH {SQL_PARITY} SELECT n, {r('mse', 'mse')} FROM p")
def table_parity(spark, sf):
    return out(_score_errors(spark, sf), "n", "mse")


@entry(
    f"""WITH {SQL_PARITY} SELECT CAST(lim AS DOUBLE) AS "limit", 'rows' AS "check", CAST(n AS DOUBLE) AS value, 0.0::DOUBLE AS threshold, CAST(n > 0 AS INTEGER) AS passed FROM p, (VALUES (0.001), (1.0)) l(lim)
  UNION ALL SELECT lim, 'mse', {r('mse', 'value').replace(' AS value', '')}, lim, CAST(mse <= lim AS INTEGER) FROM p, (VALUES (0.001), (1.0)) l(lim)"""
)
def parity_gate(spark, sf):
    """The gate on the difference of two score tables, for a strict and a loose limit."""
    errors = _score_errors(spark, sf)
    strict, loose = (quality.parity_gate(errors, lim).withColumn("limit", F.lit(lim)) for lim in (1e-3, 1.0))
    return out(strict.unionByName(loose), "limit", "check", "value", "threshold", "passed")


COEF = [((i % 7) - 3) / 10 for i in range(64)]
SQL_ATTR = """
x AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
a AS (SELECT vec_id, i, v * ((i % 7) - 3) / 10.0 AS attr FROM x)"""


@entry(
    f"""WITH {SQL_ATTR}, k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY abs(round(attr, 12)) DESC, i DESC) AS rn FROM a)
  SELECT vec_id, CAST(rn - 1 AS INTEGER) AS pos, CAST(i // 8 AS INTEGER) AS t, 'f' || (i % 8) AS f, {r('attr', 'attr')} FROM k WHERE rn <= 5"""
)
def path_attribution_topk(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    d = explain.path_attr(e, "embedding", COEF, 8)
    d = d.withColumn("attr", F.transform("attr", lambda v: F.round(v, 12)))
    d = d.select("vec_id", F.posexplode(scalars.topk_attr("attr", 8, 5)).alias("pos", "s")).select("vec_id", "pos", "s.t", "s.f", "s.attr")
    return out(d, "vec_id", "pos", "t", "f", "attr")


@entry(
    f"""WITH x AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings), m AS (SELECT i % 8 AS f, avg(v) AS m FROM x GROUP BY 1),
  a AS (SELECT vec_id, (v - m) * ((i % 7) - 3) / 10.0 AS attr FROM x JOIN m ON i % 8 = f)
  SELECT vec_id, {r('sum(attr)', 'sum')}, {r('sum(abs(attr))', 'l1')}, {r('sqrt(sum(attr * attr))', 'l2')}, {r('max(abs(attr))', 'max_abs')} FROM a GROUP BY 1"""
)
def path_attribution_summary(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    d = explain.path_attr(e, "embedding", COEF, 8, "feature_means")
    return out(d.select("vec_id", scalars.attr_summary("attr").alias("s")).select("vec_id", "s.*"), "vec_id", "sum", "l1", "l2", "max_abs")


@entry(
    f"""WITH x AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
  d AS (SELECT vec_id, i, v * v - 0.0025 AS shap FROM x), k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY abs(round(shap, 10)) DESC, i DESC) AS rn FROM d)
  SELECT vec_id, {r('sum(shap)', 'top_sum', 5)} FROM k WHERE rn <= 10 AND vec_id % 3 = 0 GROUP BY 1"""
)
def perturbation_attribution(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    alerts = e.select("vec_id", (F.col("vec_id") % 3 == 0).cast("int").alias("alert"))
    d = explain.alerts_only(e, alerts, "vec_id")
    d = explain.perturbation_attr(d, "embedding", lambda x: (x**2).sum(axis=1), [0.05] * 64, 10)
    return out(d.select("vec_id", F.aggregate("shap", F.lit(0.0), lambda a, s: a + s["shap"]).alias("top_sum")), "vec_id", "top_sum", top_sum=5)


@entry(
    f"""WITH x AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
  z AS (SELECT vec_id, sum(v) FILTER (i % 3 = 0) AS a, sum(v) FILTER (i % 3 = 1) AS b, sum(v) FILTER (i % 3 = 2) AS c FROM x GROUP BY 1)
  SELECT vec_id, {r('exp(a) / (exp(a) + exp(b) + exp(c))', 'p_wait')}, {r('exp(b) / (exp(a) + exp(b) + exp(c))', 'p_long')}, {r('exp(c) / (exp(a) + exp(b) + exp(c))', 'p_short')} FROM z"""
)
def custom_scorer(spark, sf):
    def predict(x: np.ndarray) -> np.ndarray:
        flat = x.reshape(len(x), -1)
        e = np.exp(np.stack([flat[:, k::3].sum(axis=1) for k in range(3)], axis=1))
        return e / e.sum(axis=1, keepdims=True)

    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return out(explain.score_with(e, "embedding", predict, (8, 8)), "vec_id", "p_wait", "p_long", "p_short")


@entry(
    f"""WITH {SQL_ATTR}, s AS (SELECT vec_id, sum(attr) AS s, sum(abs(attr)) AS l1 FROM a GROUP BY 1)
  SELECT CAST(vec_id AS VARCHAR) AS id, 1704067200 + vec_id * 3600 AS ts_unix, CAST(10 AS INTEGER) AS n_top, {r('s', 'sum')}, {r('l1', 'l1')} FROM s WHERE 1705500000 - (1704067200 + vec_id * 3600) <= 864000"""
)
def live_explanations(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    d = explain.path_attr(e, "embedding", COEF, 8)
    docs = explain.documents(d, F.col("vec_id").cast("string"), F.timestamp_seconds(F.lit(1704067200) + F.col("vec_id") * 3600), "attr", 8, 8)
    live = explain.live_documents(docs, 1705500000, 10)
    return out(live.select("id", "ts_unix", F.size("topk").alias("n_top"), "summary.sum", "summary.l1"), "id", "ts_unix", "n_top", "sum", "l1")


@entry(
    f"""WITH {SQL_TICKS} SELECT event_id, substr(sha256(symbol || '|' || us || '|' || user_id), 1, 16) AS decision_id FROM ticks"""
)
def decision_ids(spark, sf):
    t = ticks(spark, sf)
    return t.select("event_id", scalars.decision_id("symbol", micros("ts").cast("string"), F.col("user_id").cast("string")).alias("decision_id"))


@entry(
    f"""WITH {SQL_TICKS}, x AS (SELECT *, value / 200 AS a, user_id % 10 / 20.0 AS b FROM ticks)
  SELECT event_id, {r('CASE WHEN user_id > 0 AND value > 0 THEN ln(value / user_id) ELSE 0 END', 'lr')}, {r('ln(1 + greatest(value - 50, 0))', 'l1p')}, {r('least(greatest((value / 10 - 5 + 5) / 10, 0), 1)', 'pct')},
   {r('0.3 + 0.4 * least(greatest(a, 0), 1)', 'impact')}, {r('1 + 0.5 * least(greatest(a, 0), 1)', 'k')}, {r('greatest(0, 1 - a - b) / (greatest(0, 1 - a - b) + a + b)', 'pw')}, {r('a / (greatest(0, 1 - a - b) + a + b)', 'pl')},
   {r(f'power(0.98, ({NOW_US} - us) / 86400000000.0)', 'decay')}, {r('ln(greatest(least(a, 1), 1e-8))', 'logit')},
   CAST(CASE symbol WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 0 END AS INTEGER) AS code, CASE symbol WHEN 'view' THEN 'OKX' WHEN 'click' THEN 'Binance' ELSE symbol END AS venue,
   {r("sin(2 * pi() * ((isodow(make_timestamp(us)) - 1) * 24 + hour(make_timestamp(us))) / 168.0)", 'hs')}, strftime(make_timestamp(us), '%Y-%m-%d') AS day, CAST(json_extract(props, '$.k') AS DOUBLE) AS k_prop FROM x"""
)
def scalar_functions(spark, sf):
    t = ticks(spark, sf)
    a, b = F.col("value") / 200, (F.col("user_id") % 10) / 20.0
    pw, pl, _ = scalars.fallback_probs(a, b)
    name = F.when(F.col("symbol") == "click", "LONG").when(F.col("symbol") == "view", "SHORT").otherwise("x")
    venue = F.when(F.col("symbol") == "click", "binance").when(F.col("symbol") == "view", "okx").otherwise(F.col("symbol"))
    y, m, d = [c.alias(n) for c, n in zip(scalars.partition_columns("ts"), "ymd")]
    s = t.withColumns(
        {
            "lr": scalars.safe_log_ratio("value", "user_id"),
            "l1p": scalars.safe_log1p(F.col("value") - 50),
            "pct": scalars.z_to_pctile(F.col("value") / 10 - 5),
            "impact": scalars.impact_bps(a),
            "k": scalars.dynamic_k(a),
            "pw": pw,
            "pl": pl,
            "decay": scalars.time_decay(micros("ts"), F.lit(NOW_US)),
            "logit": scalars.logit_from_prob(F.least(a, F.lit(1.0))),
            "code": scalars.encode_label(name),
            "venue": scalars.venue_name(venue),
            "hs": scalars.hour_of_week("ts")[0],
            "day": F.concat_ws("-", y, m, d),
            "k_prop": scalars.to_number(F.get_json_object("props", "$.k")),
        }
    )
    return out(s, "event_id", "lr", "l1p", "pct", "impact", "k", "pw", "pl", "decay", "logit", "code", "venue", "hs", "day", "k_prop")


@entry(
    f"""WITH x AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS z FROM embeddings)
  SELECT vec_id, {r('exp((z[1] - list_max(z)) / 0.5) / list_sum(list_transform(z, lambda v: exp((v - list_max(z)) / 0.5)))', 'p0')},
  CAST(list_position(z, list_max(z)) - 1 AS INTEGER) AS best FROM x"""
)
def array_softmax(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("z"))
    d = e.withColumns({"p0": F.get(scalars.softmax("z", 0.5), F.lit(0)), "best": scalars.argmax("z")})
    return out(d, "vec_id", "p0", "best")


@entry(
    """WITH t AS (SELECT o_orderkey, epoch_us(o_orderdate) AS us FROM orders),
  x AS (SELECT *, CAST(CASE o_orderkey % 4 WHEN 0 THEN CAST(us // 1000000 AS VARCHAR) WHEN 1 THEN CAST(us // 1000 AS VARCHAR) WHEN 2 THEN strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%SZ') ELSE 'bad' END AS VARCHAR) AS txt FROM t)
  SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL WHEN o_orderkey % 4 = 1 AND us // 1000 < 1000000000000 THEN NULL ELSE us END AS us FROM x"""
)
def timestamp_parsing(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("ts"))
    us, kind = micros("ts"), F.col("o_orderkey") % 4
    text = (
        F.when(kind == 0, F.floor(us / 1_000_000).cast("string"))
        .when(kind == 1, F.floor(us / 1000).cast("string"))
        .when(kind == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise("bad")
    )
    small = (kind == 1) & (us / 1000 < 1e12)
    return o.withColumn("text", text).select("o_orderkey", F.when(~small, micros(scalars.to_utc("text"))).alias("us"))


def _logs(spark, sf):
    t = ticks(spark, sf).select("event_id", "value", "user_id")
    line = F.concat_ws(" ", F.concat(F.lit("fold"), F.col("user_id") % 5, F.lit(".log")), F.concat(F.lit("val_loss="), F.col("value")), F.concat(F.lit("val_loss="), F.col("user_id")), F.lit("lambda=0.98"))
    return t.withColumn("line", line)


@entry(f"SELECT event_id, CAST(user_id % 5 AS INTEGER) AS fold_id, {r('value', 'first_loss')}, CAST(user_id AS DOUBLE) AS last_loss, 0.98::DOUBLE AS lam FROM events")
def log_extraction(spark, sf):
    d = _logs(spark, sf)
    losses = scalars.extract_val_losses("line")
    d = d.select("event_id", scalars.extract_fold_id("line").alias("fold_id"), F.get(losses, F.lit(0)).alias("first_loss"), F.get(losses, F.lit(1)).alias("last_loss"), scalars.extract_lambda("line").alias("lam"))
    return out(d, "event_id", "fold_id", "first_loss", "last_loss", "lam")
