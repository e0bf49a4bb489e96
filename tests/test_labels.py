import numpy as np
import pandas as pd
import pytest
from helpers import AXIS, FIVE, pull, walk
from pyspark.sql import functions as F

from tsforge.operators import labels
from tsforge.functions.timeunits import MINUTE
from tsforge.plans.features import FEATURES, FLAGS, build_features
from tsforge.plans.labelling import label_job

CUT = AXIS.with_(bucket_us=10 * MINUTE, chunk_rows=50)


def one(spark, pdf, **kw):
    return pull(labels.triple_barrier(spark.createDataFrame(pdf), AXIS, **kw))


def test_tie_gap_and_timeout(spark):
    base = walk(60, ("A",))
    args = {"k": 1.0, "H": 5, "atr_window": 3}
    at = 30
    tie = base.copy()
    tie.loc[at + 1, ["high", "low"]] = [1e6, 1e-6]
    got = one(spark, tie, **args)
    assert got.label[at] == "WAIT"
    gap = base.copy()
    gap.loc[at + 1, ["open", "high", "low", "close"]] = [500.0, 501.0, 499.0, 500.0]
    assert one(spark, gap, **args).label[at] == "LONG"
    far = one(spark, base, k=1000.0, H=5, atr_window=3)
    assert (far.label[20:] == "WAIT").all()
    assert (far.timeout_ts - far.ts == pd.Timedelta("25min")).all() and len(far) == 55


def test_chunks_do_not_change_labels_and_recheck_agrees(spark):
    d = spark.createDataFrame(walk(400, gaps=True))
    a = pull(labels.triple_barrier(d, AXIS, H=20))
    cut = labels.triple_barrier(d, CUT, H=20)
    pd.testing.assert_frame_equal(a, pull(cut))
    check = labels.label_mismatch(cut, d, CUT, H=20).first()
    assert check["checked"] == len(a) and check["mismatches"] == 0
    assert set(a.label) == {"LONG", "SHORT", "WAIT"}
    wrong = cut.withColumn("label", F.lit("WAIT"))
    assert labels.label_mismatch(wrong, d, CUT, H=20, sample=50).first()["mismatches"] > 0


def test_windows_need_every_bar(spark):
    d = walk(60, ("A",)).drop(index=[30])
    lab = d[["symbol", "ts"]].iloc[::2].assign(label="LONG")
    got = pull(labels.sequence_windows(spark.createDataFrame(d), spark.createDataFrame(lab), CUT, 8, FIVE, ["close", "volume"]))
    for r in got.itertuples():
        part = d[(d.ts <= r.ts) & (d.ts > r.ts - pd.Timedelta(minutes=40))]
        np.testing.assert_allclose(np.stack(r.window), part[["close", "volume"]])
    late = lab.ts[(lab.ts >= d.ts.iloc[7]) & ~((lab.ts >= "2024-01-01 02:30") & (lab.ts < "2024-01-01 03:10"))]
    assert got.ts.tolist() == late.tolist() and (got.y == 1).all()


def test_features_are_complete_and_causal(spark):
    pdf = walk(260)
    for i, c in enumerate(["funding_now", "oi_now", "cvd_perp_5m", "perp_share_60m", "liq_notional_60m", "rv_5m", "funding_pctile_30d"]):
        pdf[c] = pdf.volume * (i + 1) + pdf.close
    pdf.loc[::7, "oi_now"] = None
    d = spark.createDataFrame(pdf).withColumn("oi_now", F.nanvl("oi_now", F.lit(None)))
    full = pull(build_features(d, AXIS, warmup=40))
    assert list(full.columns) == ["symbol", "ts", *FEATURES, *FLAGS] and not full.isna().any().any()
    assert len(full) == 2 * 220 and full._imputed_oi_now.sum() > 0
    cut = pull(build_features(d, CUT, warmup=40))
    pd.testing.assert_frame_equal(full, cut, rtol=1e-7)
    part = pull(build_features(d.where("ts < '2024-01-01 15:00'"), AXIS, warmup=40))
    same = part.merge(full, on=["symbol", "ts"])
    for c in FEATURES:
        np.testing.assert_allclose(same[c + "_x"], same[c + "_y"], rtol=1e-7, atol=1e-9)


def test_label_job_joins_prices(spark):
    d = spark.createDataFrame(walk(80))
    feats = d.select("symbol", "ts", "volume")
    assert label_job(feats, AXIS, d, H=10).count() == 2 * 70
    with pytest.raises(ValueError, match="raw bars"):
        label_job(feats, AXIS)
