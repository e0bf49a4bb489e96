import json

import numpy as np
import pandas as pd
import pytest
from helpers import AXIS, FIVE, pull, walk
from pyspark.sql import functions as F

from tsforge.functions import scalars
from tsforge.operators import explain, model, monitor, quality
from tsforge.session import scratch_path
from tsforge.sources import lake, landing


def docs(spark, *payloads):
    return spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(payloads)], "doc int, payload string")


def test_record_list_is_found_anywhere(spark):
    bar = {"t": 1704067200, "o": 1, "h": 2, "l": 0.5, "c": "1.5", "volumeUsd": 7}
    raw = docs(spark, [bar], {"data": [bar]}, {"data": {"list": [bar], "rows": [{"x": 1}]}}, {"rows": [{"x": 1}], "result": [bar]}, {"code": 1}, {"data": []})
    good, bad = landing.normalise_records(raw, "payload", landing.PRICE)
    got = good.toPandas()
    assert sorted(got.doc) == [0, 1, 2, 3] and (got.close == 1.5).all() and (got.volume_usd == 7).all() and bad.count() == 0
    broken = spark.createDataFrame([(0, "{not json")], "doc int, payload string")
    assert landing.normalise_records(broken, "payload", landing.PRICE)[0].count() == 0


def test_aliases_zero_and_rejects(spark):
    raw = docs(spark, [{"time": "2024-01-01T00:00:00Z", "f": 0, "value": 3}, {"ts": 1704067200000, "fundingRate": "0.5"}, {"ts": 1704067200000, "funding": "n/a"}, {"f": 1}])
    good, bad = landing.normalise_records(raw, "payload", landing.FUNDING)
    assert sorted(r["funding_now"] for r in good.collect()) == [0.0, 0.5] and bad.count() == 2
    strict, _ = landing.normalise_records(raw, "payload", landing.FUNDING, zero_is_missing=True)
    assert sorted(r["funding_now"] for r in strict.collect()) == [0.5, 3.0]
    assert {str(r["ts"]) for r in good.collect()} == {"2024-01-01 00:00:00"}
    taker, _ = landing.normalise_records(docs(spark, [{"t": 1, "buyUsd": 4}]), "payload", landing.TAKER_VOLUME)
    assert taker.first()["taker_buy_usd"] == 4 and taker.first()["taker_sell_usd"] == 0
    assert set(landing.SPECS) == {"price", "open_interest", "funding", "taker_volume", "liquidation"}


def test_daily_lake(spark):
    path = scratch_path(spark, "lake")
    d = spark.createDataFrame(walk(600))
    lake.write_daily(d, path)
    assert spark.read.parquet(path).count() == 1200
    m = lake.build_manifest(spark, path).toPandas()
    assert len(m) == 3 and m["rows"].sum() == 1200 and (m.sha256.str.len() == 64).all() and (m["cols"] == 7).all()
    # Only the touched day is replaced.
    lake.write_daily(d.where("ts >= '2024-01-03'").withColumn("close", F.lit(0.0)), path)
    again = lake.build_manifest(spark, path).toPandas().set_index("d").sha256
    old = m.set_index("d").sha256
    assert again["01"] == old["01"] and again["03"] != old["03"] and spark.read.parquet(path).count() == 1200
    with pytest.raises(ValueError, match="duplicate"):
        lake.write_daily(d.union(d), path)
    pruned = lake.scan_days(spark, path, "2024-01-02 00:00:00", "2024-01-03 00:00:00")
    assert pruned.count() == 576 and "PartitionFilters: [" in pruned._jdf.queryExecution().toString()
    days = lake.complete_days(lake.build_manifest(spark, path))
    plan = lake.plan_days(lake.day_range(spark, "2024-01-01", "2024-01-06"), days, 2)
    assert sorted(str(r["day"]) for r in plan.collect()) == ["2024-01-04", "2024-01-05", "2024-01-06"]
    assert lake.plan_days(lake.day_range(spark, "2024-01-01", "2024-01-03"), days, force=True).count() == 3
    assert lake.named_view(d, "v").first()["n"] == 1200
    assert lake.rows_per_group(10) == 1_000_000 and lake.rows_per_group(1e6) == 50_000


def test_pushdown_and_pruning(spark):
    path = scratch_path(spark, "wide")
    spark.createDataFrame(walk(50)).write.parquet(path)
    d = lake.scan(spark, path, ["symbol", "close"]).where("symbol = 'A'")
    plan = d._jdf.queryExecution().toString()
    assert "ReadSchema: struct<symbol:string,close:double>" in plan and "EqualTo(symbol,A)" in plan


def test_events_and_reports(spark):
    path = scratch_path(spark, "ev")
    d = spark.createDataFrame([("A", 5.0)], "symbol string, t_nn_ms double")
    lake.write_events(d, path)
    spark.createDataFrame([("{oops",)], "value string").write.mode("append").text(path)
    good, bad = lake.read_events(spark, path)
    assert good.first()["t_nn_ms"] == 5.0 and good.first()["ts"] is not None and bad.count() == 1
    rep = scratch_path(spark, "rep")
    lake.write_report(quality.table_summary(spark.createDataFrame(walk(10))), rep)
    assert spark.read.json(rep).first()["n"] == 20
    tab = scratch_path(spark, "csv")
    lake.write_table_csv(lake.lineage(spark, [("close", "price", "bars")]), tab)
    assert spark.read.option("header", True).csv(tab).first()["feature"] == "close"


def test_islands_and_slices(spark):
    d = spark.sql("SELECT explode(array(DATE'2024-01-01', DATE'2024-01-02', DATE'2024-01-05')) AS day")
    got = [(str(r["start"]), str(r["end"])) for r in lake.islands(d, []).orderBy("start").collect()]
    assert got == [("2024-01-01", "2024-01-03"), ("2024-01-05", "2024-01-06")]
    s = spark.sql("SELECT TIMESTAMP'2024-01-01' AS a, TIMESTAMP'2024-03-05' AS b")
    parts = lake.time_slices(s, "a", "b").orderBy("slice_start").collect()
    assert len(parts) == 3 and str(parts[-1]["slice_end"]) == "2024-03-05 00:00:00"


def test_scalars(spark):
    d = spark.createDataFrame([(0.0, -1.0, None)], "a double, b double, c double")
    row = d.select(
        scalars.safe_log_ratio("a", "b").alias("lr"),
        scalars.safe_log1p("b").alias("l"),
        scalars.safe_log1p("c").alias("n"),
        scalars.range_ratio("a", "b", "a").alias("rr"),
        scalars.argmax(F.array(F.lit(1), F.lit(3), F.lit(3))).alias("am"),
        scalars.decode_label(F.lit(2)).alias("lab"),
        scalars.venue_name(F.lit("okx")).alias("v"),
        scalars.venue_name(F.lit("")).alias("e"),
        scalars.extract_lambda(F.lit("decay λ=0.98")).alias("lam"),
    ).first()
    assert row.asDict() == {"lr": 0.0, "l": 0.0, "n": None, "rr": 0.0, "am": 1, "lab": "SHORT", "v": "OKX", "e": None, "lam": 0.98}
    assert scalars.threshold_grid(0.5, 0.8, 0.025)[-1] == pytest.approx(0.8) and len(scalars.threshold_grid(0.5, 0.8, 0.025)) == 13
    ids = [spark.range(1).select(scalars.decision_id(F.lit("A"), F.lit("t"), F.lit(w)).alias("i")).first()["i"] for w in ("x", "x", "y")]
    assert ids[0] == ids[1] != ids[2] and len(ids[0]) == 16


def test_attribution_and_documents(spark):
    d = spark.createDataFrame([("a", [1.0, -4.0, 2.0, 3.0], 0), ("b", [0.0] * 4, 1)], "id string, w array<double>, alert int")
    attr = explain.path_attr(d, "w", [1.0, 1.0, 2.0, 0.5], 2)
    doc = explain.documents(attr, "id", F.timestamp_seconds(F.lit(1_000_000)), "attr", 2, 2, 2, ["p", "q"])
    row = doc.where("id = 'a'").first()
    assert [(x["t"], x["f"], x["attr"]) for x in row["topk"]] == [(1, "p", 4.0), (0, "q", -4.0)]
    assert row["summary"]["sum"] == 2.5 and row["summary"]["l1"] == 10.5 and row["summary"]["max_abs"] == 4 and row["window_shape"] == [2, 2]
    path = scratch_path(spark, "docs")
    doc.write.parquet(path)
    assert explain.live_documents(doc, 1_000_000, 0).count() == 2
    assert explain.collect_garbage(spark, path, 1_000_001, 0) == 2 and spark.read.parquet(path).count() == 0
    shap = explain.perturbation_attr(explain.alerts_only(d, d), "w", lambda x: x.sum(axis=1), [1.0] * 4, 3)
    got = shap.first()["shap"]
    assert len(got) == 3 and all(s["shap"] == -1.0 for s in got)


def test_models_learn_and_score(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 300)
    x = rng.normal(0, 1, (300, 4))
    x[np.arange(300), y] += 4
    pdf = pd.DataFrame({"symbol": "A", "ts": pd.date_range("2024-01-01", periods=300, freq="5min"), "window": list(x), "y": y})
    d = spark.createDataFrame(pdf)
    us = 1_704_067_200_000_000
    f = spark.createDataFrame([(0, "train", us, us + 200 * FIVE), (0, "val", us + 210 * FIVE, us + 250 * FIVE), (0, "oos", us + 260 * FIVE, us + 299 * FIVE)], "fold_id int, split string, start_us bigint, end_us bigint")
    f = f.unionByName(f.where("split = 'train'").selectExpr("7 AS fold_id", "split", "start_us", f"{us + 90 * FIVE} AS end_us"))
    rows, scale = model.training_rows(d, f, 2)
    models = model.fit_folds(rows, tol=1e-7)
    fitted = {r["fold_id"]: r for r in models.collect()}
    assert set(fitted) == {0, 7} and all(r["gradient"] <= 1e-7 for r in fitted.values())
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    peer = LogisticRegression(family="multinomial", maxIter=200, tol=1e-10, regParam=0.01, standardization=False, featuresCol="_x", labelCol="y", weightCol="weight")
    for fold, r in fitted.items():
        other = peer.fit(rows.where(f"fold_id = {fold} AND split = 'train'").withColumn("_x", array_to_vector("window")))
        coef = np.array(r["coef"])
        np.testing.assert_allclose(coef[:, :-1], other.coefficientMatrix.toArray(), atol=2e-3)
        np.testing.assert_allclose(coef[:, -1], other.interceptVector.toArray(), atol=2e-3)
    out = model.score_folds(models, rows, ["symbol", "ts"]).where("fold_id = 0")
    got = out.toPandas()
    assert set(got.split) == {"val", "oos"} and len(got) == 81
    assert (got[["p_wait", "p_long", "p_short"]].to_numpy().argmax(axis=1) == got.y).mean() > 0.85
    assert quality.check_probs(out, ["p_wait", "p_long", "p_short"]).where("not passed").count() == 0
    assert {len(r["mean"]) for r in scale.collect()} == {2}


def test_latency_and_sla(spark):
    d = spark.createDataFrame([(float(i), float(i), 5.0) for i in range(1, 101)], "t_feat_ms double, t_nn_ms double, t_policy_ms double").withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    rep = monitor.latency_report(d, cols=["t_feat_ms"], now=F.lit("2024-01-01 00:02:00").cast("timestamp")).toPandas().set_index("horizon")
    assert rep.p50["all"] == 50.5 and rep.p99["5m"] == pytest.approx(99.01) and "1m" not in rep.index
    flags = monitor.sla_flags(d).groupBy("exceed_stage").count().collect()
    assert {r["exceed_stage"]: r["count"] for r in flags} == {None: 20, "feat": 10, "nn": 70}


def test_gates(spark):
    p = spark.createDataFrame([(0.2, 0.3, 0.5), (0.2, 0.3, 0.6)], "a double, b double, c double")
    assert quality.check_probs(p, ["a", "b", "c"]).where("not passed").first()["check"] == "sum_not_one"
    d = pull(spark.createDataFrame(walk(20, ("A",))))
    feats = spark.createDataFrame(d.assign(**{f"f{i}": 1.0 for i in range(12)}, _imputed_x=0).drop(columns=["open", "high", "low", "close", "volume"]))
    assert quality.feature_qa(feats, AXIS, FIVE, ms_per_bar=1.0).where("not passed").count() == 0
    few = feats.select("symbol", "ts", "f0", "f1")
    assert quality.feature_qa(few, AXIS, FIVE).where("not passed").first()["check"] == "n_features_min"
    lab = spark.createDataFrame(d[["symbol", "ts"]].assign(label="WAIT", tp_px=1.0, sl_px=1.0, timeout_ts=d.ts))
    bad = {r["check"] for r in quality.label_qa(lab, feats, ["symbol", "ts"]).where("not passed").collect()}
    assert bad == {"wait_share"}
