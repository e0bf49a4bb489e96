"""Composite jobs, gates on their output, and the remaining sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tsforge.catalog import Registry
from tsforge.catalog.data import BARS, H, SQL_BARS, SQL_TICKS, bars, out, r, table, ticks
from tsforge.catalog.decisions import EXPRS, FEATURE_SQL, FW, SQL_POLICY, _position_sql, measured_bars, policy_rows
from tsforge.catalog.labelling import LABELS
from tsforge.catalog.scoring import SQL_PROBS, minority, probs
from tsforge.functions import scalars
from tsforge.functions.timeunits import HOUR
from tsforge.operators import align, calibrate, folds, labels, model, monitor, policy, quality, sampling
from tsforge.plans import features as feature_plan
from tsforge.plans.labelling import decision_job, label_job
from tsforge.session import cut_lineage, scratch_path
from tsforge.sources import lake

ENTRIES = Registry()
entry = ENTRIES.entry


@entry(f"WITH {SQL_BARS}, {LABELS} SELECT symbol, ts_us, label, {r('tp', 'tp_px')} FROM labels_tb")
def label_job_with_prices(spark, sf):
    """Features without prices: prices are joined from the bars first."""
    b = bars(spark, sf)
    return out(label_job(b.select("symbol", "ts", "volume"), BARS, b), "symbol", "ts", "label", "tp_px")


@entry(
    f"""WITH {SQL_BARS}, {FEATURE_SQL}, g AS (SELECT * FROM f4 WHERE pos >= {FW}),
  i AS (SELECT greatest(avg(CAST(funding_now IS NULL AND fund IS NOT NULL AS DOUBLE)), avg(CAST(oi_now IS NULL AND oi IS NOT NULL AS DOUBLE))) AS v FROM g),
  c AS (SELECT max(gap) AS v FROM (SELECT 1 - count(DISTINCT ts_us) / ((max(ts_us) - min(ts_us)) // {H} + 1) AS gap FROM g GROUP BY symbol))
  SELECT 'n_features_min' AS "check", 16.0::DOUBLE AS value, 10.0::DOUBLE AS threshold, 1 AS passed UNION ALL SELECT 'n_features_max', 16, 20, 1 UNION ALL SELECT 'null_ratio', 0, 0, 1
  UNION ALL SELECT 'imputed_ratio', round(v, 6), 0.05, CAST(v <= 0.05 AS INTEGER) FROM i UNION ALL SELECT 'gap_ratio', round(v, 6), 0.005, CAST(v <= 0.005 AS INTEGER) FROM c UNION ALL SELECT 'dup_key_count', 0, 0, 1"""
)
def feature_gate(spark, sf):
    d = cut_lineage(feature_plan.build_features(measured_bars(spark, sf), BARS, warmup=FW))
    return out(quality.feature_qa(d, BARS, HOUR), "check", "value", "threshold", "passed")


@entry(
    f"""WITH {SQL_TICKS} SELECT event_id, {r('CASE WHEN value > 100 THEN 0 ELSE value END', 'a')}, {r('CASE WHEN value < 5 THEN 0 WHEN value > 200 THEN 0 ELSE value END', 'b')}, CAST(CASE WHEN user_id > 50 THEN 0 ELSE user_id END AS BIGINT) AS c FROM ticks"""
)
def clean_measures(spark, sf):
    t = ticks(spark, sf)
    inf, nan = F.lit(float("inf")), F.lit(float("nan"))
    d = t.select(
        "event_id",
        F.when(F.col("value") > 100, nan).otherwise(F.col("value")).alias("a"),
        F.when(F.col("value") < 5, inf).when(F.col("value") > 200, -inf).otherwise(F.col("value")).alias("b"),
        F.when(F.col("user_id") <= 50, F.col("user_id")).alias("c"),
    )
    return out(scalars.clean_numeric(d, ("event_id",)), "event_id", "a", "b", "c")


@entry(
    """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS priority FROM orders"""
)
def merged_schema_scan(spark, sf):
    """Two batches of files with different columns, aligned by name."""
    path = scratch_path(spark, "mixed")
    o = table(spark, sf, "orders").withColumn("k", F.col("o_orderkey"))
    o.where("o_orderkey % 2 = 0").select("k", F.col("o_totalprice").alias("price")).write.parquet(f"{path}/a=0")
    o.where("o_orderkey % 2 = 1").select("k", F.col("o_orderpriority").alias("priority")).write.parquet(f"{path}/a=1")
    return lake.scan(spark, path, merge_schema=True, ts=None).select("k", "price", "priority")


@entry(f"WITH {SQL_PROBS} SELECT fold_id, count(*) AS n, {r('avg(z0)', 'z0')} FROM probs GROUP BY 1")
def probability_scan(spark, sf):
    """Fold files read by glob; the fold number comes from the file name."""
    path = scratch_path(spark, "probs")
    p = probs(spark, sf)
    for k in range(5):
        p.where(F.col("fold_id") == k).drop("fold_id").write.parquet(f"{path}/fold{k}.parquet")
    d = lake.read_probs(spark, f"{path}/*.parquet").groupBy("fold_id")
    return out(d.agg(F.count(F.lit(1)).alias("n"), F.avg("logits_0").alias("z0")), "fold_id", "n", "z0")


@entry(f"WITH {SQL_BARS} SELECT DISTINCT strftime(make_timestamp(ts_us), '%Y-%m-%d') AS day FROM bars")
def complete_days(spark, sf):
    path = scratch_path(spark, "lake")
    lake.write_daily(bars(spark, sf), path)
    return lake.complete_days(lake.build_manifest(spark, path)).select(F.col("day").cast("string").alias("day"))


@entry(
    f"""WITH {SQL_BARS}, x AS (SELECT symbol, ts_us, CASE WHEN ts_us >= epoch_us(TIMESTAMP '2024-01-20') AND ts_us < epoch_us(TIMESTAMP '2024-01-21') THEN volume * 2 ELSE volume END AS volume FROM bars)
  SELECT symbol, count(*) AS n, {r('sum(volume)', 'volume')} FROM x GROUP BY 1"""
)
def lake_upsert(spark, sf):
    """Late corrections of one day replace its rows; other days are not rewritten."""
    path = scratch_path(spark, "lake")
    b = bars(spark, sf)
    lake.write_daily(b, path)
    new = b.where("ts >= '2024-01-20' AND ts < '2024-01-21'").withColumn("volume", F.col("volume") * 2)
    lake.append_rows(spark, new, path, ["symbol"])
    d = spark.read.parquet(path).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume"))
    return out(d, "symbol", "n", "volume")


@entry(
    f"""WITH {SQL_BARS}, {SQL_POLICY} SELECT symbol, strftime(make_timestamp(ts_us), '%Y-%m-%d') AS date, {r("avg(CAST(side <> 'WAIT' AS DOUBLE))", 'alert_rate')} FROM dec GROUP BY 1, 2"""
)
def daily_alert_rate(spark, sf):
    d = monitor.alert_rate(policy.ev_decision(policy_rows(spark, sf)), by=["symbol"])
    return out(d.withColumn("date", F.col("date").cast("string")), "symbol", "date", "alert_rate")


@entry("SELECT o_orderpriority, count(*) AS n, " + r("count(*) / (SELECT count(*) FROM orders)", "share") + " FROM orders GROUP BY 1")
def class_histogram(spark, sf):
    return out(quality.class_mix(table(spark, sf, "orders"), "o_orderpriority"), "o_orderpriority", "n", "share")


@entry("SELECT l_orderkey, count(*) AS n FROM lineitem SEMI JOIN (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderstatus = 'P') o ON l_orderkey = o_orderkey GROUP BY 1")
def semi_join_by_keys(spark, sf):
    keys = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey")).dropDuplicates()
    d = table(spark, sf, "lineitem").select("l_orderkey").join(keys, "l_orderkey", "left_semi")
    return d.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@entry(f"WITH {SQL_BARS} SELECT symbol, ts_us, {r('close', 'close')} FROM bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts_us DESC) = 1")
def last_per_key(spark, sf):
    return out(align.keep_last(bars(spark, sf).select("symbol", "ts", "close"), ["symbol"], ["ts"]), "symbol", "ts", "close")


@entry("SELECT o_orderkey, o_orderstatus FROM orders ORDER BY md5('42|' || o_orderkey), o_orderkey LIMIT 500")
def hash_sample(spark, sf):
    """A sample of 500 orders by a hash of their key: the operator is a sample."""
    return labels.sample_rows(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"], 500)


@entry(_position_sql(False, 0.55))
def decision_job_output(spark, sf):
    """Every decision of the job with its side and reason, in the fixed schema."""
    rows = cut_lineage(policy_rows(spark, sf))
    d = decision_job(rows.drop("p_long", "p_short", "p_wait"), rows.select("symbol", "ts", "p_long", "p_short", "p_wait"), BARS, every=HOUR, H=12)
    return out(d, "symbol", "ts", "side", "size", "TP_px", "SL_px", "EV_bps", "k_atr", "vol_pctile", "liq60_pctile", "reason", "tau_long", TP_px=4, SL_px=4, EV_bps=3)


@entry()
def augmented_model(spark, sf):
    """Over-sampled TRAIN windows -> per-fold classifier -> class metrics on the raw rows."""
    d = cut_lineage(minority(spark, sf))
    aug = sampling.smote(d, "embedding", "label", ["fold_id"], "vec_id")
    aug = cut_lineage(aug.select("fold_id", F.col("embedding").alias("window"), scalars.encode_label("label").alias("y")))
    scale = model.feature_scale(aug, "window", 8, ["fold_id"])
    models = model.fit_folds(model.augmented_rows(aug, scale, 8))
    raw = d.select("vec_id", "fold_id", F.lit("oos").alias("split"), F.col("embedding").alias("window"), scalars.encode_label("label").alias("y"))
    rows = model.standardise_windows(raw, scale, "window", 8, ["fold_id"])
    scored = model.score_folds(models, rows, ["vec_id"])
    named = scored.withColumnsRenamed({"p_wait": "p_0", "p_long": "p_1", "p_short": "p_2"})
    return out(calibrate.class_metrics(named, ["fold_id"]), "fold_id", "class", "precision", "recall", "support", precision=3, recall=3)


@entry(
    f"""WITH {SQL_BARS}, s AS (SELECT symbol, min(ts_us) AS lo, max(ts_us) AS hi FROM bars GROUP BY 1),
  f AS (SELECT 0 AS fold_id, 1704500000000000 AS oos, 1705000000000000 AS oos_e UNION ALL SELECT 1, 1705500000000000, 1706000000000000),
  v AS (SELECT fold_id, oos - {24 * H} - {48 * H} + 1 AS a, oos - {24 * H} AS b FROM f)
  SELECT CAST(fold_id AS INTEGER) AS fold_id, 'val' AS split, count(*) AS n FROM bars JOIN v ON ts_us BETWEEN a AND b GROUP BY 1"""
)
def synthetic_validation(spark, sf):
    b = bars(spark, sf)
    rows = [(0, "train", 0, 1704200000000000), (0, "oos", 1704500000000000, 1705000000000000), (1, "train", 0, 1705200000000000), (1, "oos", 1705500000000000, 1706000000000000)]
    f = folds.fill_missing_val(spark.createDataFrame(rows, folds.SCHEMA), b, "ts", HOUR, 48, 24 * HOUR)
    return folds.fold_counts(folds.assign_folds(b, f.where("split = 'val'")))


@entry(f"WITH {SQL_BARS} SELECT symbol, ts_us, {r(EXPRS['hl_range'], 'hl_range')}, {r(EXPRS['co_ret'], 'co_ret')} FROM bars")
def bar_ratios(spark, sf):
    d = bars(spark, sf).withColumns({"hl_range": scalars.range_ratio("high", "low", "close"), "co_ret": scalars.safe_log_ratio("close", "open")})
    return out(d, "symbol", "ts", "hl_range", "co_ret")


@entry(
    f"""WITH o AS (SELECT CAST(o_orderkey % 5 AS INTEGER) AS fold_id, CASE o_orderstatus WHEN 'F' THEN 'LONG' WHEN 'P' THEN 'SHORT' ELSE 'WAIT' END AS label FROM orders),
  s AS (SELECT fold_id, avg(CAST(label = 'WAIT' AS DOUBLE)) AS v FROM o GROUP BY 1)
  SELECT fold_id, 'wait_share' AS "check", {r('v', 'value')}, 0.6::DOUBLE AS threshold, CAST(v <= 0.6 AS INTEGER) AS passed FROM s"""
)
def class_mix_gate(spark, sf):
    lab = F.when(F.col("o_orderstatus") == "F", "LONG").when(F.col("o_orderstatus") == "P", "SHORT").otherwise("WAIT")
    o = table(spark, sf, "orders").select((F.col("o_orderkey") % 5).cast("int").alias("fold_id"), lab.alias("label"))
    return out(quality.class_mix_gate(o), "fold_id", "check", "value", "threshold", "passed")


@entry(
    f"""WITH l AS (SELECT CAST(user_id % 5 AS INTEGER) AS fold_id, event_id, value FROM events), s AS (SELECT fold_id, (arg_min(value, event_id) - min(value)) / greatest(arg_min(value, event_id), 1e-9) AS g FROM l GROUP BY 1)
  SELECT fold_id, 'loss_improvement' AS "check", {r('g', 'value')}, 0.05::DOUBLE AS threshold, CAST(g >= 0.05 AS INTEGER) AS passed FROM s
  UNION ALL SELECT fold_id, 'decay_low', 0.98, 0.95, 1 FROM s UNION ALL SELECT fold_id, 'decay_high', 0.98, 1.0, 1 FROM s"""
)
def training_gate(spark, sf):
    """Fold, loss and decay factor are read out of log lines."""
    t = ticks(spark, sf)
    line = F.concat(F.lit("fold"), F.col("user_id") % 5, F.lit(" lambda=0.98 val_loss="), F.col("value"))
    d = t.select("event_id", line.alias("line"))
    d = d.select("event_id", scalars.extract_fold_id("line").alias("fold_id"), F.get(scalars.extract_val_losses("line"), F.lit(0)).alias("loss"), scalars.extract_lambda("line").alias("lam"))
    return out(quality.training_gate(d, "fold_id", "event_id", "loss", "lam"), "fold_id", "check", "value", "threshold", "passed")


@entry(f"WITH {SQL_BARS}, g AS (SELECT symbol, min(ts_us) AS lo, max(ts_us) AS hi FROM bars GROUP BY 1) SELECT symbol, unnest(range(lo, hi + 1, {H})) AS us FROM g")
def grid_table_function(spark, sf):
    from tsforge.functions.registered import register

    register(spark)
    bars(spark, sf).createOrReplaceTempView("tsforge_grid_bars")
    return spark.sql(
        f"""SELECT s.symbol, g.us FROM (SELECT symbol, min(unix_micros(ts)) AS lo, max(unix_micros(ts)) AS hi FROM tsforge_grid_bars GROUP BY symbol) s,
        LATERAL grid_rows(s.lo, s.hi, {HOUR}L) g"""
    )


@entry(
    f"""WITH x AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS z FROM embeddings),
  e AS (SELECT vec_id, z, list_transform(z, lambda v: exp((v - list_max(z)) / 0.5)) AS e FROM x)
  SELECT vec_id, {r('e[1] / list_sum(e)', 'first')}, {r('list_max(e) / list_sum(e)', 'most')}, CAST(len(e) AS INTEGER) AS size FROM e"""
)
def softmax_from_sql(spark, sf):
    """The registered array function over all components."""
    from tsforge.functions.registered import register

    register(spark)
    table(spark, sf, "embeddings").createOrReplaceTempView("tsforge_vectors")
    d = spark.sql("SELECT vec_id, softmax_array(CAST(embedding AS array<double>), 0.5D) AS p FROM tsforge_vectors")
    return out(d.select("vec_id", F.get("p", F.lit(0)).alias("first"), F.array_max("p").alias("most"), F.size("p").alias("size")), "vec_id", "first", "most", "size")


@entry(
    f"""WITH {SQL_PROBS}, x AS (SELECT fold_id, split, y, exp(z0) / (exp(z0) + exp(z1) + exp(z2)) AS a, exp(z1) / (exp(z0) + exp(z1) + exp(z2)) AS b, exp(z2) / (exp(z0) + exp(z1) + exp(z2)) AS c FROM probs),
  q AS (SELECT fold_id, split, greatest(a, b, c) AS conf, CAST(CASE WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END = y AS INTEGER) AS hit FROM x),
  g AS (SELECT fold_id, split, ceil(conf * 15) AS bin, sum(hit) AS h, sum(conf) AS k, count(*) AS n FROM q GROUP BY 1, 2, 3)
  SELECT fold_id, split, {r('sum(abs(h - k)) / sum(n)', 'ece')} FROM g GROUP BY 1, 2"""
)
def calibration_error_from_sql(spark, sf):
    """The registered aggregate over the bins of each fold and split: a group has one row a bin."""
    from tsforge.functions.registered import register

    register(spark)
    p = probs(spark, sf)
    a, b, c = scalars.softmax3(F.col("logits_0"), F.col("logits_1"), F.col("logits_2"))
    top = F.when((a >= b) & (a >= c), 0).when(b >= c, 1).otherwise(2)
    p.select("fold_id", "split", F.greatest(a, b, c).alias("conf"), (top == F.col("y")).cast("int").alias("hit")).createOrReplaceTempView("tsforge_confidence")
    d = spark.sql(
        """SELECT fold_id, split, ece_of_bins(h, k, n) AS ece
        FROM (SELECT fold_id, split, ceil(conf * 15) AS bin, CAST(sum(hit) AS DOUBLE) AS h, sum(conf) AS k, CAST(count(*) AS DOUBLE) AS n FROM tsforge_confidence GROUP BY 1, 2, 3)
        GROUP BY fold_id, split"""
    )
    return out(d, "fold_id", "split", "ece")
