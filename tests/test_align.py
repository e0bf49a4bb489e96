import pandas as pd
import pytest
from helpers import AXIS, FIVE, pull, walk
from pyspark.sql import functions as F

from tsforge.functions.timeunits import MINUTE
from tsforge.operators import align, quality
from tsforge.operators.layout import Axis


def test_minute_bars_to_quarter_hours(spark):
    pdf = pd.DataFrame({"ts": pd.date_range("2024-01-01", periods=60, freq="1min"), "i": range(60)})
    pdf["symbol"], pdf["open"], pdf["close"] = "X", pdf.i * 1.0, pdf.i * 1.0
    pdf["high"], pdf["low"], pdf["volume"] = pdf.i + 1.0, (pdf.i - 1.0).clip(lower=0), 1.0
    bars = pull(align.resample_ohlcv(spark.createDataFrame(pdf.drop(columns="i")), AXIS, 15 * MINUTE))
    # The 00:00 row alone forms the bar of the first midnight, which is dropped.
    assert list(bars.ts.astype(str).str[11:16]) == ["00:15", "00:30", "00:45", "01:00"]
    assert bars.volume.iloc[0] == 15 and bars.open.iloc[0] == 1 and bars.close.iloc[0] == 15


def test_fill_is_limited_and_flagged(spark):
    values = [1.0] + [None] * 4 + [2.0] + [None] * 14
    pdf = pd.DataFrame({"symbol": "X", "ts": pd.date_range("2024-01-01", periods=20, freq="5min"), "x": values})
    out = pull(align.ffill_limit(spark.createDataFrame(pdf, "symbol string, ts timestamp, x double").select("symbol", "ts", F.nanvl("x", F.lit(None)).alias("x")), AXIS, ["x"], 3))
    assert out.x.iloc[1:4].tolist() == [1.0] * 3 and pd.isna(out.x.iloc[4])
    assert out.x_imputed.sum() == 6


def test_sparse_series_on_grid(spark):
    pdf = pd.DataFrame({"symbol": "X", "ts": pd.to_datetime(["2024-01-01 00:00", "2024-01-01 00:20", "2024-01-01 00:40"]), "f": [1.0, 5.0, 2.0]})
    out = pull(align.ffill_limit(spark.createDataFrame(pdf), AXIS, ["f"], 3, every=FIVE))
    assert len(out) == 9 and out.f.notna().all() and out.f_imputed.sum() == 6


def test_unique_key_raises(spark):
    d = spark.createDataFrame([("A", 1), ("A", 1), ("B", 2)], "symbol string, x int")
    with pytest.raises(ValueError, match="duplicate keys"):
        quality.assert_unique(d, ["symbol", "x"])
    assert quality.duplicate_keys(d, ["symbol", "x"]).collect()[0]["n"] == 2


def test_perfect_day_passes_and_gap_fails(spark):
    day = walk(288, ("A",))
    cols = ["open", "close"]
    gate = quality.bar_qa(spark.createDataFrame(day), AXIS, FIVE, cols)
    assert quality.require(gate).where("passed").count() == 4
    with pytest.raises(ValueError, match="gap_ratio"):
        quality.require(quality.bar_qa(spark.createDataFrame(day.drop(index=range(50, 60))), AXIS, FIVE, cols))


def test_missing_and_grid(spark):
    day = walk(50, ("A",)).drop(index=[7, 8])
    gone = pull(align.missing_ts(spark.createDataFrame(day), AXIS, FIVE))
    assert gone.ts.astype(str).str[11:16].tolist() == ["00:35", "00:40"]


def test_long_grid_crosses_blocks(spark):
    pdf = pd.DataFrame({"symbol": "A", "ts": pd.to_datetime(["2024-01-01", "2024-01-12"])})
    assert align.time_grid(spark.createDataFrame(pdf), AXIS, FIVE).count() == 11 * 288 + 1


def test_fallback_and_outer(spark):
    a = spark.createDataFrame([("A", 1, 1.0)], "symbol string, t int, v double")
    b = spark.createDataFrame([("A", 2, 2.0), ("B", 3, 3.0)], "symbol string, t int, v double")
    assert sorted(r["v"] for r in align.first_source([a, b], ["symbol"]).collect()) == [1.0, 3.0]
    both = align.combine_measures([a.withColumnRenamed("v", "x"), b.withColumnRenamed("v", "y")], ["symbol", "t"])
    assert both.count() == 3


def test_axis_with_two_keys(spark):
    pdf = walk(20, ("A",)).assign(venue="v")
    axis = Axis(("symbol", "venue"), "ts", bucket_us=60 * MINUTE)
    assert align.resample_ohlcv(spark.createDataFrame(pdf), axis, 15 * MINUTE).count() == 7
