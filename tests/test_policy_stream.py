import numpy as np
import pandas as pd
import pytest
from helpers import AXIS, FIVE, pull, walk
from pyspark.sql import Window
from pyspark.sql import functions as F

from tsforge.functions.timeunits import MINUTE
from tsforge.operators import calibrate, monitor, policy, trades
from tsforge.operators.scan import run_states
from tsforge.plans.labelling import decision_job
from tsforge.session import scratch_path
from tsforge.streaming import jobs, states

CUT = AXIS.with_(bucket_us=10 * MINUTE, chunk_rows=40)


def frame(spark, closes, pl=0.7, ps=0.1, **cols):
    pdf = pd.DataFrame({"symbol": "A", "ts": pd.date_range("2024-01-01", periods=len(closes), freq="5min"), "close": np.asarray(closes, float)})
    pdf["high"], pdf["low"] = pdf.close, pdf.close
    pdf["atr_pct"], pdf["vol_pctile"], pdf["liq60_pctile"], pdf["p_long"], pdf["p_short"], pdf["p_wait"] = 0.01, 0.5, 0.0, pl, ps, 0.2
    return spark.createDataFrame(pdf.assign(**cols))


def reasons(spark, closes, **kw):
    opts = {k: kw.pop(k) for k in ("H", "early_exit", "tau_long") if k in kw}
    return pull(policy.position_policy(frame(spark, closes, **kw), AXIS, **opts)).reason.tolist()


def test_position_rules(spark):
    assert reasons(spark, [100], pl=0.5)[0] == "TAU"
    assert reasons(spark, [100], pl=0.58, atr_pct=0.0)[0] == "EV≤0"
    assert reasons(spark, [100] * 5) == ["ENTER", "OVERLAP", "OVERLAP", "OVERLAP", "OVERLAP"]
    assert reasons(spark, [100, 98, 98], H=36) == ["ENTER", "EXIT_SL", "COOLDOWN"]
    assert reasons(spark, [100, 103, 103], H=1) == ["ENTER", "EXIT_TP", "ENTER"]
    assert reasons(spark, [100] * 4, early_exit=True)[3] == "EARLY_EXIT_NO_FT"
    assert reasons(spark, [100, 102], pl=0.1, ps=0.8) == ["ENTER", "EXIT_SL"]


def test_cooldown_and_follow_through(spark):
    d = frame(spark, [100, 99.9, 99.8, 99.6, 99.6])
    got = pull(policy.cooldown_policy(policy.ev_decision(d), AXIS, H=36))
    assert got.side.tolist() == ["LONG"] + ["WAIT"] * 4
    assert got.reason.tolist() == ["enter", "cooldown", "cooldown", "early_exit", "cooldown"]
    moved = frame(spark, [100, 101, 101, 101, 101])
    assert "early_exit" not in pull(policy.cooldown_policy(policy.ev_decision(moved), AXIS, H=36)).reason.tolist()


def random_rows(spark, rows=400):
    pdf = walk(rows, seed=7)
    rng = np.random.default_rng(1)
    pdf["atr_pct"], pdf["vol_pctile"], pdf["liq60_pctile"] = 0.004, rng.random(len(pdf)), rng.random(len(pdf))
    pdf["p_long"], pdf["p_short"], pdf["p_wait"] = rng.random(len(pdf)) * 0.8, rng.random(len(pdf)) * 0.8, 0.1
    return spark.createDataFrame(pdf)


def test_chunked_state_machines_equal_one_pass(spark):
    d = random_rows(spark)
    for fn in (
        lambda a: policy.position_policy(d, a, H=7),
        lambda a: policy.position_policy(d, a, H=7, early_exit=True),
        lambda a: policy.cooldown_policy(policy.ev_decision(d), a, H=7),
    ):
        one, many = pull(fn(AXIS)), pull(fn(CUT))
        pd.testing.assert_frame_equal(one, many[one.columns])


def test_chunks_that_never_agree_still_come_out_right(spark):
    """Every bar is a candidate, so each chunk depends on all before it."""
    d = frame(spark, [100.0] * 200)
    args = {"H": 7}
    one = pull(policy.cooldown_policy(policy.ev_decision(d), AXIS, **args))
    many = pull(policy.cooldown_policy(policy.ev_decision(d), CUT, **args))
    pd.testing.assert_frame_equal(one, many[one.columns])
    assert (one.side != "WAIT").sum() == -(-200 // 7)


def replayed(d, early, cool, follow=None, H=None):
    """The two policies bar by bar, one state per key."""
    out = []
    for _, rows in d.groupby("symbol"):
        held, last = None, None
        for i, r in enumerate(rows.sort_values("ts").itertuples()):
            us = r.ts.value // 1000
            if follow is not None:
                if not np.isfinite(r.close):
                    out.append("no_close")
                    continue
                if last is not None and us - last["us"] < H * FIVE:
                    age, why = (us - last["us"]) // FIVE, "cooldown"
                    if 1 <= age <= 3 and not last["done"]:
                        last["path"].append(r.close)
                    if age == 3 and not last["done"]:
                        last["done"] = True
                        sign = 1 if last["side"] == "LONG" else -1
                        best = max([0.0, *(sign * (c - last["close"]) for c in last["path"])])
                        goal = sign * (last["tp"] - last["close"])
                        why = "early_exit" if goal > 0 and best < follow * goal else why
                    out.append(why)
                    continue
                if r.side != "WAIT":
                    last = {"us": us, "side": r.side, "close": r.close, "tp": r.TP_px, "path": [], "done": False}
                out.append("")
                continue
            if held:
                up, bars = held["side"] == "LONG", i - held["at"]
                if (r.low <= held["sl"]) if up else (r.high >= held["sl"]):
                    why = "EXIT_SL"
                elif (r.high >= held["tp"]) if up else (r.low <= held["tp"]):
                    why = "EXIT_TP"
                elif early and bars >= 3 and ((r.close <= held["close"]) if up else (r.close >= held["close"])):
                    why = "EARLY_EXIT_NO_FT"
                else:
                    why = "OVERLAP"
                held = held if why == "OVERLAP" else None
            elif last is not None and us - last < cool:
                why = "COOLDOWN"
            else:
                why = r._want if hasattr(r, "_want") else r.want
                if why == "ENTER":
                    held, last = {"at": i, "side": r.side_, "close": r.close, "tp": r.tp_, "sl": r.sl_}, us
            out.append(why)
    return out


@pytest.mark.parametrize("chunk_rows, wide", [(100_000, 1), (40, 1), (20, 12)])
def test_entries_equal_a_replay(spark, chunk_rows, wide):
    """Narrow barriers end in a few bars, wide ones many chunks later or never."""
    pdf = walk(600, seed=chunk_rows + wide)
    rng = np.random.default_rng(wide)
    pdf["atr_pct"], pdf["vol_pctile"], pdf["liq60_pctile"] = 0.002 * wide, 0.5, rng.random(len(pdf))
    pdf["p_long"], pdf["p_short"], pdf["p_wait"] = rng.random(len(pdf)), rng.random(len(pdf)), 0.1
    pdf = pdf[rng.random(len(pdf)) < 0.9]  # gaps in time
    d = spark.createDataFrame(pdf)
    axis = AXIS.with_(bucket_us=10 * MINUTE, chunk_rows=chunk_rows)
    flat = policy.position_inputs(d, 0.55, 0.55, 0.5, 1.0, 1.5).withColumnsRenamed({"_want": "want", "_side": "side_", "_tp": "tp_", "_sl": "sl_"}).toPandas().sort_values(["symbol", "ts"])
    for early in (True,) if wide == 1 else (False,):
        got = pull(policy.position_policy(d, axis, H=7, early_exit=early))
        assert got.sort_values(["symbol", "ts"]).reason.tolist() == replayed(flat, early, 7 * FIVE)
    ev = policy.ev_decision(d.withColumn("close", F.when(F.col("p_wait") + F.col("p_long") % 0.1 < 0.105, float("nan")).otherwise(F.col("close"))))
    base = ev.toPandas().sort_values(["symbol", "ts"])
    for H in (7,) if chunk_rows > 20 else (2,):
        got = pull(policy.cooldown_policy(ev, axis, H=H, follow=0.3)).sort_values(["symbol", "ts"])
        want = replayed(base, False, 0, 0.3, H)
        assert got.reason.tolist() == [w or r for w, r in zip(want, base.reason.tolist())]


def test_an_open_position_over_many_chunks_takes_few_rounds(spark):
    d = frame(spark, [100.0] * 1000, atr_pct=0.5)  # never touched
    axis = AXIS.with_(bucket_us=10 * MINUTE, chunk_rows=8)
    got = pull(policy.position_policy(d, axis, H=7))
    assert got.reason.tolist() == ["ENTER"] + ["OVERLAP"] * 999
    assert trades.entries.rounds <= 10
    d = frame(spark, [100.0] * 1000)  # every bar is a candidate, so each chunk hangs on all before it
    got = pull(policy.cooldown_policy(policy.ev_decision(d), axis, H=7))
    assert (got.side != "WAIT").sum() == -(-1000 // 7) and trades.entries.rounds <= 10


def test_decision_job_schema_and_sink(spark):
    d = random_rows(spark, 50)
    path = scratch_path(spark, "dec")
    out = decision_job(d.drop("p_long", "p_short", "p_wait"), d.select("symbol", "ts", "p_long", "p_short", "p_wait"), AXIS, path)
    assert [f"{n} {t}" for n, t in out.dtypes] == [f"{n} {t}" for n, t in policy.DECISION_COLUMNS]
    assert spark.read.parquet(path).count() == 100
    with pytest.raises(ValueError, match="missing decision columns"):
        policy.with_decision_schema(d)


def landed(spark, df, parts):
    """Write ``df`` as several files in time order and stream them one file per batch."""
    path = scratch_path(spark, "in")
    days = df.withColumn("_p", F.ntile(parts).over(Window.orderBy("ts")))
    for i in range(1, parts + 1):
        days.where(F.col("_p") == i).drop("_p").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def finish(spark, sdf):
    path = scratch_path(spark, "out")
    query = jobs.run_to_path(sdf, path, scratch_path(spark, "cp"))
    query.awaitTermination()
    return spark.read.schema(sdf.schema).parquet(path), query


def test_stream_policy_equals_batch(spark):
    d = random_rows(spark, 90)
    ready = policy.position_inputs(d, 0.55, 0.55, 0.5, 1.0, 1.5)
    batch = pull(policy.position_policy(d, AXIS, H=7))
    s = states.stream_states(landed(spark, ready, 3), ["symbol"], "ts", *states.policy_runner(7 * FIVE))
    out, _ = finish(spark, policy.position_outputs(s, AXIS))
    pd.testing.assert_frame_equal(batch, pull(out))


def test_stream_bars_and_late_rows(spark):
    d = spark.createDataFrame(walk(200, ("A",)))
    late = spark.createDataFrame(walk(1, ("A",)))
    path = scratch_path(spark, "in")
    d.coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 1).parquet(path)
    bars = jobs.stream_ohlcv(stream, AXIS, 15 * MINUTE, "close", "volume", "30 minutes")
    cp, out = scratch_path(spark, "cp"), scratch_path(spark, "out")
    jobs.run_to_path(bars, out, cp).awaitTermination()
    n = spark.read.parquet(out).count()
    assert 60 <= n < 68
    late.coalesce(1).write.mode("append").parquet(path)
    query = jobs.run_to_path(bars, out, cp)
    query.awaitTermination()
    assert jobs.late_rows(query) == 1 and spark.read.parquet(out).where("bar < '2024-01-01 00:10'").count() <= 1


def test_queue_batches_replayed_change_nothing(spark):
    path = scratch_path(spark, "queue")
    sink = jobs.queue_sink(path)
    rows = lambda *x: spark.createDataFrame(list(x), "decision_id string, state string, ts int")
    sink(rows(("a", "queued", 1), ("b", "queued", 1), ("a", "queued", 2)), 0)
    sink(rows(("a", "done", 5)), 1)
    before = sorted(map(tuple, jobs.read_queue(spark, path).collect()))
    assert before == [("a", "done", 5), ("b", "queued", 1)]
    sink(rows(("a", "queued", 1), ("b", "queued", 1), ("a", "queued", 2)), 0)
    assert sorted(map(tuple, jobs.read_queue(spark, path).collect())) == before


def test_batches_into_daily_lake(spark):
    from tsforge.sources.lake import append_rows

    d = spark.createDataFrame(walk(400, ("A",)))
    lake = scratch_path(spark, "lake")
    stream = landed(spark, d, 3)
    jobs.run_batches(stream, lambda df, _: append_rows(df.sparkSession, df, lake, ["symbol"]), scratch_path(spark, "cp")).awaitTermination()
    assert spark.read.parquet(lake).count() == 400


def test_telemetry_line(spark):
    d = spark.createDataFrame([("RAM 1/2MB CPU@55C GPU@72C GPU@85%",), ("nothing",)], "line string")
    a, b = states.parse_telemetry(d).collect()
    assert (a["temp_c"], a["gpu_util"]) == (72.0, 85.0) and b["temp_c"] is None
    rows = d.limit(1).withColumns({"symbol": F.lit("A"), "ts": F.lit("2024-01-01").cast("timestamp")})
    out = run_states(states.parse_telemetry(rows), AXIS, *states.telemetry_runner()).first()
    assert out["throttle"] == 1 and out["transition"] == 1


def test_throttle_join(spark):
    dec = frame(spark, [100], pl=0.58)
    tele = spark.createDataFrame([("A", 1)], "symbol string, throttle int")
    got = policy.throttle_cushion(jobs.throttle_state(policy.ev_decision(dec), tele, ["symbol"])).first()
    assert got["side"] == "WAIT" and got["reason"] == "throttle"


def test_calibration_improves(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 600)
    z = rng.normal(0, 2, (600, 3))
    z[np.arange(600), y] += 1
    pdf = pd.DataFrame({"fold_id": np.arange(600) % 2, "split": np.where(np.arange(600) < 300, "val", "oos"), "y": y, "row": np.arange(600)})
    for i in range(3):
        pdf[f"logits_{i}"] = z[:, i] * 4
    d = spark.createDataFrame(pdf)
    fit = calibrate.fit_temperature(d).toPandas()
    assert (fit.temperature > 5).all()  # found in the wide grid
    raw = calibrate.nll(d.where("split = 'val'"), ["fold_id"]).toPandas()
    assert (fit.sort_values("fold_id").nll_val.values <= raw.sort_values("fold_id").nll.values).all()
    w = calibrate.ensemble_weights(d, calibrate.fit_temperature(d)).toPandas()
    assert w.weight.sum() == pytest.approx(1) and (w.weight >= 0).all()
    merged = calibrate.merge_calibrated(d, calibrate.fit_temperature(d), calibrate.ensemble_weights(d, calibrate.fit_temperature(d)), "oos", ["row"])
    assert merged.select(F.max(F.abs(F.col("p_0") + F.col("p_1") + F.col("p_2") - 1))).first()[0] < 1e-6
    with pytest.raises(ValueError, match="no logits"):
        calibrate.with_logits(d.select("y"))


def test_threshold_choice(spark):
    rows = [(0.6, 1, 1), (0.65, 1, 1), (0.7, 2, 1), (0.55, 1, 0), (0.52, 2, 0), (0.58, 2, 0), (0.9, 0, 0), (0.64, 1, 1), (0.68, 2, 1)]
    data = []
    for i, (p, cls, ok) in enumerate(rows):
        probs = [(1 - p) / 2] * 3
        probs[cls] = p
        data.append((0, "oos", i, cls if ok else (cls + 1) % 3, *probs))
    d = spark.createDataFrame(data, "fold_id int, split string, row int, y int, p_0 double, p_1 double, p_2 double")
    calib = spark.createDataFrame([(0, 1.0)], "fold_id int, temperature double")
    s = calibrate.tau_summary(d, calib, "row").first()
    assert 0.575 <= s["best_tau"] <= 0.675


def test_cusum_and_trigger(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, 1000)
    x[500:] += 2
    pdf = pd.DataFrame({"symbol": "A", "ts": pd.date_range("2024-01-01", periods=1000, freq="5min"), "rv": x})
    d = spark.createDataFrame(pdf)
    h = monitor.cusum_threshold(d, AXIS, "rv", boot_n=100, q=0.95)
    assert h.first()["h"] > 0
    parts = monitor.cusum_threshold(d, AXIS, "rv", boot_n=100, q=0.95, part_rows=7)
    assert parts.first()["h"] == pytest.approx(h.first()["h"], abs=1e-9)
    a = pull(monitor.cusum_regimes(d, AXIS, "rv", h))
    b = pull(monitor.cusum_regimes(d, CUT, "rv", h))
    assert a.changed.sum() >= 1 and a.changed.tolist() == b.changed.tolist() and a.regime_id.tolist() == b.regime_id.tolist()
    ooc = spark.createDataFrame([(True,)], "out_of_control boolean")
    quiet = spark.createDataFrame([(False,)], "out_of_control boolean")
    still = spark.createDataFrame(a.assign(changed=0))
    assert monitor.retrain_trigger(ooc, still, AXIS).first()["reason"] == "alert_rate_ooc"
    assert monitor.retrain_trigger(quiet, still, AXIS).count() == 0
    assert monitor.retrain_trigger(quiet, still.withColumn("changed", F.lit(1)), AXIS).first()["reason"] == "regime_shift"
