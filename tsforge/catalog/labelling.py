"""Labels, windows, gates and order statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tsforge.catalog import Registry
from tsforge.catalog.data import BARS, H, SQL_BARS, bars, out, r, table
from tsforge.catalog.statistics import ATR, W
from tsforge.functions.timeunits import DAY, HOUR
from tsforge.operators import labels, quality, ranks
from tsforge.session import cut_lineage

ENTRIES = Registry()
entry = ENTRIES.entry

# Labels by a join on row numbers: a different algorithm from the framed one.
LABELS = f"""{ATR},
lp AS (SELECT symbol, ts_us, close * (1 + 1.2 * atr_pct) AS tp, close * (1 - 1.2 * atr_pct) AS sl, row_number() OVER ({W}) AS pos,
       lead(ts_us, 36) OVER ({W}) AS timeout_us, greatest(open, high) AS hi, least(open, low) AS lo FROM atr),
touch AS (SELECT a.symbol, a.ts_us, arg_min(CASE WHEN b.hi >= a.tp AND b.lo <= a.sl THEN 'WAIT' WHEN b.hi >= a.tp THEN 'LONG' ELSE 'SHORT' END, b.pos) AS label
  FROM lp a JOIN lp b ON a.symbol = b.symbol AND b.pos > a.pos AND b.pos <= a.pos + 36 AND (b.hi >= a.tp OR b.lo <= a.sl) GROUP BY 1, 2),
labels_tb AS (SELECT symbol, ts_us, coalesce(label, 'WAIT') AS label, tp, sl, timeout_us, pos FROM lp LEFT JOIN touch USING (symbol, ts_us) WHERE timeout_us IS NOT NULL)"""


@entry(f"WITH {SQL_BARS}, {LABELS} SELECT symbol, ts_us, label, {r('tp', 'tp_px')}, {r('sl', 'sl_px')}, timeout_us AS timeout_ts FROM labels_tb")
def triple_barrier(spark, sf):
    d = labels.triple_barrier(bars(spark, sf), BARS)
    return out(d, "symbol", "ts", "label", "tp_px", "sl_px", "timeout_ts")


@entry(f"WITH {SQL_BARS}, {LABELS} SELECT symbol, ts_us, label FROM labels_tb WHERE pos > 15")
def triple_barrier_no_warmup(spark, sf):
    d = labels.triple_barrier(bars(spark, sf), BARS.with_(chunk_rows=300), drop_warmup=True)
    return out(d, "symbol", "ts", "label")


@entry(f"WITH {SQL_BARS}, {LABELS} SELECT count(*) AS checked, CAST(0 AS BIGINT) AS mismatches, CAST(0 AS DOUBLE) AS ratio FROM labels_tb")
def label_recheck(spark, sf):
    b = bars(spark, sf)
    return labels.label_mismatch(labels.triple_barrier(b, BARS), b, BARS)


@entry(f"WITH {SQL_BARS}, {LABELS} SELECT label, count(*) AS n, {r('count(*) / (SELECT count(*) FROM labels_tb)', 'share')} FROM labels_tb GROUP BY 1")
def label_mix(spark, sf):
    return out(quality.class_mix(labels.triple_barrier(bars(spark, sf), BARS), "label"), "label", "n", "share")


@entry(
    f"""WITH {SQL_BARS}, {LABELS}, s AS (SELECT count(*) AS n, avg(CAST(label = 'WAIT' AS DOUBLE)) AS w FROM labels_tb)
  SELECT 'rows' AS "check", CAST(n AS DOUBLE) AS value, 0.0::DOUBLE AS threshold, CAST(n > 0 AS INTEGER) AS passed FROM s
  UNION ALL SELECT x, 0.0, 0.0, 1 FROM (VALUES ('nulls'), ('outside_allowed_set'), ('dup_key_count'), ('labels_without_features')) v(x)
  UNION ALL SELECT 'wait_share', round(w, 6), 0.8, CAST(w <= 0.8 AS INTEGER) FROM s"""
)
def label_gate(spark, sf):
    b = bars(spark, sf)
    return out(quality.label_qa(labels.triple_barrier(b, BARS), b, ["symbol", "ts"]), "check", "value", "threshold", "passed")


@entry(
    f"""WITH {SQL_BARS}, {LABELS}, w AS (SELECT symbol, ts_us, list(close) OVER f AS a, list(volume) OVER f AS b, count(*) OVER f AS n, min(ts_us) OVER f AS t0
    FROM bars WINDOW f AS ({W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))
  SELECT symbol, ts_us, label, CAST(CASE label WHEN 'LONG' THEN 1 WHEN 'SHORT' THEN 2 ELSE 0 END AS INTEGER) AS y,
    CAST(n * 2 AS INTEGER) AS len, {r('a[1]', 'first_close')}, {r('b[12]', 'last_volume')}, {r('list_sum(a) + list_sum(b)', 'total', 4)}
  FROM w JOIN labels_tb USING (symbol, ts_us) WHERE n = 12 AND ts_us - t0 = 11 * {H}"""
)
def sequence_windows(spark, sf):
    b = bars(spark, sf)
    lab = cut_lineage(labels.triple_barrier(b, BARS))
    d = labels.sequence_windows(b, lab, BARS, 12, HOUR, ["close", "volume"], flat=True)
    d = d.withColumns(
        {
            "len": F.size("window"),
            "first_close": F.get("window", F.lit(0)),
            "last_volume": F.get("window", F.lit(23)),
            "total": F.aggregate("window", F.lit(0.0), lambda a, x: a + x),
        }
    )
    return out(d, "symbol", "ts", "label", "y", "len", "first_close", "last_volume", "total", total=4)


PROFILE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@entry(
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, 'double' AS dtype, {r(f'sum(CAST({c} IS NULL AS DOUBLE)) / count(*)', 'nan_ratio')}, {r('avg(CAST(l_discount > 0.05 AS DOUBLE))' if c == 'l_tax' else '0.0::DOUBLE', 'imputed_ratio')}, min({c}) AS min, max({c}) AS max FROM lineitem"
        for c in PROFILE_COLS
    )
)
def column_profile(spark, sf):
    li = table(spark, sf, "lineitem").select(*PROFILE_COLS, (F.col("l_discount") > 0.05).alias("flag"))
    return out(quality.profile(li, PROFILE_COLS, {"l_tax": "flag"}), "name", "dtype", "nan_ratio", "imputed_ratio", "min", "max")


@entry(
    f"""WITH {SQL_BARS} SELECT symbol, CAST((max(ts_us) - min(ts_us)) // {H} + 1 AS BIGINT) AS expected_bars, count(DISTINCT ts_us) AS present_bars,
  {r(f'1 - count(DISTINCT ts_us) / ((max(ts_us) - min(ts_us)) // {H} + 1)', 'gap_ratio')}, count(*) - count(DISTINCT ts_us) AS dup_key_count FROM bars GROUP BY 1"""
)
def bar_coverage(spark, sf):
    return out(quality.coverage(bars(spark, sf), BARS, HOUR), "symbol", "expected_bars", "present_bars", "gap_ratio", "dup_key_count")


@entry(
    f"""WITH {SQL_BARS}, hi AS (SELECT symbol, max(ts_us) AS hi FROM bars GROUP BY 1),
  x AS (SELECT b.* FROM bars b JOIN hi USING (symbol) WHERE ts_us >= hi - {20 * DAY}),
  s AS (SELECT symbol, 1 - count(DISTINCT ts_us) / {20 * 24 + 1} AS gap, avg(CAST(close > 60 AS DOUBLE)) AS imp FROM x GROUP BY 1)
  SELECT symbol, 'gap_ratio' AS "check", {r('gap', 'value')}, 0.005::DOUBLE AS threshold, CAST(gap <= 0.005 AS INTEGER) AS passed FROM s
  UNION ALL SELECT symbol, 'null_ratio', 0, 0, 1 FROM s
  UNION ALL SELECT symbol, 'imputed_ratio', {r('imp', 'v')}, 0.05, CAST(imp <= 0.05 AS INTEGER) FROM s
  UNION ALL SELECT symbol, 'dup_key_count', 0, 0, 1 FROM s"""
)
def bar_gate(spark, sf):
    b = bars(spark, sf).withColumn("_imputed_close", F.col("close") > 60)
    d = quality.bar_qa(b, BARS, HOUR, ["open", "high", "low", "close", "volume"], {"close": "_imputed_close"}, 20 * DAY)
    return out(d, "symbol", "check", "value", "threshold", "passed")


@entry("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "orders").select("o_custkey"), ["o_custkey"])


@entry("SELECT count(*) AS n, epoch_us(min(ts)) AS min_ts, epoch_us(max(ts)) AS max_ts FROM events")
def table_summary(spark, sf):
    return out(quality.table_summary(table(spark, sf, "events").select("ts")), "n", "min_ts", "max_ts")


@entry("SELECT (SELECT count(*) FROM lineitem) AS n, count(*) AS joined, CAST(count(*) = (SELECT count(*) FROM lineitem) AS INTEGER) AS ok FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def join_integrity(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"))
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    return out(quality.join_integrity(li, o, ["k"]), "n", "joined", "ok")


@entry("SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')")
def values_outside_set(spark, sf):
    return quality.new_values(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


@entry(
    """WITH t AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'F'), m AS (SELECT o_orderkey AS k FROM orders WHERE o_totalprice > 100000),
  h AS (SELECT l_orderkey AS k FROM lineitem WHERE l_quantity > 45)
  SELECT 'train_outside_mask' AS "check", CAST(count(*) AS DOUBLE) AS value, 0.0::DOUBLE AS threshold, CAST(count(*) = 0 AS INTEGER) AS passed FROM t ANTI JOIN m USING (k)
  UNION ALL SELECT 'mask_in_held_out', count(*), 0, CAST(count(*) = 0 AS INTEGER) FROM m SEMI JOIN h USING (k)"""
)
def mask_set_checks(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus", "o_totalprice")
    held = table(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("k"))
    mask = o.select("k", (F.col("o_totalprice") > 100000).cast("int").alias("keep"))
    return out(quality.set_checks(o.where("o_orderstatus = 'F'"), mask, held, ["k"]), "check", "value", "threshold", "passed")


@entry(
    f"""SELECT l_returnflag, prob, {r('quantile', 'quantile')} FROM (
  SELECT l_returnflag, unnest([0.01, 0.25, 0.5, 0.99])::DOUBLE AS prob, unnest(quantile_cont(l_extendedprice, [0.01, 0.25, 0.5, 0.99])) AS quantile FROM lineitem GROUP BY 1)"""
)
def exact_quantiles(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    d = ranks.exact_quantiles(li, ["l_returnflag"], "l_extendedprice", [0.01, 0.25, 0.5, 0.99])
    return out(d, "l_returnflag", "prob", "quantile")


@entry(
    f"""SELECT o_orderkey, o_orderpriority, {r('(rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_orderpriority, o_totalprice) - 1) / 2) / count(*) OVER (PARTITION BY o_orderpriority)', 'vol_pctile')} FROM orders"""
)
def global_pct_rank(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    d = ranks.pct_rank(o, ["o_orderpriority"], "o_totalprice", "vol_pctile")
    return out(d, "o_orderkey", "o_orderpriority", "vol_pctile")


KS_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@entry(
    """WITH x AS (SELECT *, l_shipdate < TIMESTAMP '1998-06-01' AS a FROM lineitem), """
    + ", ".join(
        f"""v{i} AS (SELECT '{c}' AS feature, {c} AS v, CAST(a AS INTEGER) AS na, CAST(NOT a AS INTEGER) AS nb FROM x)""" for i, c in enumerate(KS_COLS)
    )
    + f""", l AS (SELECT * FROM v0 UNION ALL SELECT * FROM v1 UNION ALL SELECT * FROM v2),
  g AS (SELECT feature, v, sum(na) AS na, sum(nb) AS nb FROM l GROUP BY 1, 2),
  c AS (SELECT feature, sum(na) OVER w AS ca, sum(nb) OVER w AS cb, sum(na) OVER (PARTITION BY feature) AS ta, sum(nb) OVER (PARTITION BY feature) AS tb FROM g WINDOW w AS (PARTITION BY feature ORDER BY v)),
  d AS (SELECT feature, max(abs(ca / ta - cb / tb)) AS d, max(ta) AS ta, max(tb) AS tb FROM c GROUP BY 1)
  SELECT feature, {r('d', 'd')}, {r('least(1.0, 2 * exp(-2 * (ta * tb / (ta + tb)) * d * d))', 'p')}, CAST(ta AS BIGINT) AS n_a, CAST(tb AS BIGINT) AS n_b FROM d"""
)
def ks_between_periods(spark, sf):
    li = table(spark, sf, "lineitem").select("l_shipdate", *KS_COLS)
    cut = F.col("l_shipdate") < F.lit("1998-06-01").cast("timestamp_ntz")
    d = ranks.ks_two_sample(li.where(cut), li.where(~cut), KS_COLS)
    return out(d, "feature", "d", "p", "n_a", "n_b")


@entry(
    f"""WITH m AS (SELECT l_returnflag, median(l_extendedprice) AS med FROM lineitem GROUP BY 1),
  a AS (SELECT l_returnflag, median(abs(l_extendedprice - med)) AS mad FROM lineitem JOIN m USING (l_returnflag) GROUP BY 1)
  SELECT l_orderkey, l_linenumber, {r('(l_extendedprice - med) / CASE WHEN mad = 0 THEN 1 ELSE mad END', 'price_rz')} FROM lineitem JOIN m USING (l_returnflag) JOIN a USING (l_returnflag)"""
)
def robust_scale(spark, sf):
    from tsforge.operators.sampling import robust_scale

    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    d = robust_scale(li, ["l_returnflag"], {"l_extendedprice": "price_rz"})
    return out(d, "l_orderkey", "l_linenumber", "price_rz")
