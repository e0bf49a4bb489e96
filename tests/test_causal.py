import numpy as np
import pandas as pd
import pytest
from helpers import AXIS, pull, walk
from pyspark.sql import functions as F

from tsforge.functions.timeunits import MINUTE
from tsforge.operators import causal, layout
from tsforge.operators.layout import over_frames, with_position

CUT = AXIS.with_(bucket_us=10 * MINUTE, chunk_rows=37)  # several chunks with halos


@pytest.fixture(scope="module")
def bars(spark):
    return spark.createDataFrame(walk(gaps=True)).persist()


@pytest.fixture(scope="module")
def local():
    return walk(gaps=True).sort_values(["symbol", "ts"]).reset_index(drop=True)


def by_symbol(local, fn):
    return np.concatenate([np.asarray(fn(g)) for _, g in local.groupby("symbol")])


@pytest.mark.parametrize("window", [5, 80])
def test_winsor_and_zscore_match_pandas(bars, local, window):
    want = by_symbol(local, lambda g: causal.winsor_values(g.close.reset_index(drop=True), window))
    for method in ("sql", "pandas"):
        got = pull(causal.winsorize_causal(bars, CUT, "close", window, out="w", method=method))
        np.testing.assert_allclose(got.w, want, rtol=1e-9)
    want = by_symbol(local, lambda g: causal.zscore_values(g.volume.reset_index(drop=True), window))
    for method in ("sql", "pandas"):
        got = pull(causal.zscore_causal(bars, CUT, "volume", window, "z", method=method))
        np.testing.assert_allclose(got.z.astype(float), want, rtol=1e-6, atol=1e-9)


def test_zscore_uses_only_the_past(spark):
    pdf = pd.DataFrame({"symbol": "X", "ts": pd.date_range("2024-01-01", periods=100, freq="5min"), "x": np.arange(100.0)})
    z = pull(causal.zscore_causal(spark.createDataFrame(pdf), AXIS, "x", 10, "z")).z
    past = np.arange(40, 50.0)
    assert z[50] == pytest.approx((49 - past.mean()) / past.std())


def test_halo_equals_whole_series(bars, local):
    def build(d, w):
        return d.withColumns({"a": F.sum("volume").over(w.rowsBetween(-20, 15)), "b": F.lag("close", 9).over(w)})

    cut = pull(over_frames(bars, CUT, build, back=20, ahead=15))
    whole = pull(over_frames(bars, AXIS, build, back=20, ahead=15))
    pd.testing.assert_frame_equal(cut[whole.columns], whole)


def test_hot_bucket_with_many_chunks(spark):
    """A third of the rows in one bucket; chunks of one row; wide halo."""
    pdf = walk(90, ("A",))
    pdf.loc[30:59, "ts"] = pd.Timestamp("2024-01-01 02:30") + pd.to_timedelta(range(30), unit="s")
    d = spark.createDataFrame(pdf)

    def build(d, w):
        return d.withColumn("a", F.sum("volume").over(w.rowsBetween(-3, 3)))

    cut = pull(over_frames(d, AXIS.with_(bucket_us=MINUTE, chunk_rows=1), build, back=3, ahead=3))
    whole = pull(over_frames(d, AXIS, build, back=3, ahead=3))
    pd.testing.assert_frame_equal(cut[whole.columns], whole)


def test_positions_cumulative_and_time_frames(bars, local):
    got = pull(with_position(bars, CUT))
    assert got.pos.tolist() == by_symbol(local, lambda g: range(len(g))).tolist()
    got = pull(causal.cumulative(bars, CUT, {"volume": "total"}))
    np.testing.assert_allclose(got.total, by_symbol(local, lambda g: g.volume.cumsum()))
    got = pull(causal.rolling_time(bars, CUT, {"volume": "s"}, 60 * MINUTE))
    want = by_symbol(local, lambda g: g.set_index("ts").volume.rolling("60min").sum())
    np.testing.assert_allclose(got.s, want)
    got = pull(causal.rolling_pctile(bars, CUT, {"close": "p"}, 240 * MINUTE))
    want = by_symbol(local, lambda g: g.set_index("ts").close.rolling("240min").apply(lambda x: (x <= x.iloc[-1]).mean()))
    np.testing.assert_allclose(got.p, want)


def test_tail_and_warmup(bars, local):
    got = pull(causal.tail_per_key(bars, CUT, 45))
    want = local.groupby("symbol").tail(45).reset_index(drop=True)
    assert got.ts.tolist() == want.ts.tolist()
    got = pull(causal.drop_warmup(bars, CUT, 100))
    assert len(got) == sum(len(g) - 100 for _, g in local.groupby("symbol"))


def test_atr_is_causal(spark, bars, local):
    full = pull(causal.atr_pct(bars, CUT, 14))
    head = spark.createDataFrame(local[local.ts < "2024-01-01 12:00"])
    part = pull(causal.atr_pct(head, CUT, 14))
    joined = part.merge(full, on=["symbol", "ts"])
    assert len(joined) == len(part)
    np.testing.assert_allclose(joined.atr_pct_x, joined.atr_pct_y)


def test_layout_too_large_to_broadcast(spark, bars):
    """The same result through shuffle joins."""

    def build(d, w):
        return d.withColumn("a", F.sum("volume").over(w.rowsBetween(-20, 15)))

    a = pull(over_frames(bars, CUT, build, back=20, ahead=15))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = pull(over_frames(bars, CUT, build, back=20, ahead=15))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    pd.testing.assert_frame_equal(a, b)


def test_hot_time_buckets_are_counted_finer(spark):
    """A day of 3000 rows, most of them within one hour, in chunks of 100 rows."""
    rng = np.random.default_rng(5)
    us = np.sort(np.r_[rng.choice(3600, 2400, replace=False), 3600 + rng.choice(80000, 600, replace=False)])
    pdf = pd.DataFrame({"symbol": "A", "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(us, unit="s"), "x": rng.normal(size=3000)})
    d = spark.createDataFrame(pdf)
    cut = AXIS.with_(bucket_us=24 * 60 * MINUTE, chunk_rows=100)
    pieces, several = layout.split(d, cut)
    sizes = pieces.groupBy("_chunk").count().toPandas()["count"]
    assert several and sizes.max() <= 200 and sizes.sum() == 3000
    whole = AXIS.with_(bucket_us=24 * 60 * MINUTE)
    for fn in (lambda a: causal.rolling_rows(d, a, "x", 30, "sum", "y"), lambda a: causal.rolling_time(d, a, {"x": "y"}, 10 * MINUTE)):
        pd.testing.assert_series_equal(pull(fn(whole)).y, pull(fn(cut)).y)
    pieces, _ = layout.split(d, cut, back_us=10 * MINUTE)  # with halos: no more than the rows of ten minutes more
    assert pieces.groupBy("_chunk").count().toPandas()["count"].max() <= 200 + 2400
