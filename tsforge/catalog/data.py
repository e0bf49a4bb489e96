"""The driver tables as keyed series, in Spark and as matching SQL fragments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge.functions.scalars import nan_to_null
from tsforge.functions.timeunits import DAY, HOUR, micros
from tsforge.operators.align import resample_ohlcv
from tsforge.operators.layout import Axis
from tsforge.session import apply_settings

TICKS = Axis("symbol", "ts", bucket_us=DAY)  # times are unique per symbol
ORDERS = Axis("symbol", "ts", bucket_us=400 * DAY, ties=("event_id",))  # many orders per day
BARS = Axis("symbol", "ts", bucket_us=10 * DAY)
DAILY = Axis("symbol", "ts", bucket_us=400 * DAY)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    apply_settings(spark)
    return nan_to_null(spark.read.parquet(f"{sf}/{name}.parquet"))


def ticks(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(
        F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), "value", "user_id", "event_id", "props"
    )


def bars(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly bars of the event stream: price = value, volume = user_id.

    The bars are written once (the lake table of a real deployment), so the ticks are
    aggregated once however many operators read the bars.
    """
    t = ticks(spark, sf).select("symbol", "ts", "value", "user_id", "event_id")
    return resample_ohlcv(t, TICKS, HOUR, price="value", volume="user_id")


def daily(spark: SparkSession, sf: str) -> DataFrame:
    """Daily bars of order totals per priority, 1995-2001."""
    o = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("symbol"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_totalprice").alias("value"),
        F.lit(1.0).alias("n"),
        F.col("o_orderkey").alias("event_id"),
    )
    return resample_ohlcv(o, ORDERS, DAY, price="value", volume="n")


def out(df: DataFrame, *cols, **rounded: int) -> DataFrame:
    """Final projection: time as epoch microseconds, doubles rounded to 6 digits."""
    picked = []
    for c in cols:
        name = c if isinstance(c, str) else None
        if name == "ts":
            picked.append(micros("ts").alias("ts_us"))
        elif name is not None:
            kind = df.schema[name].dataType.simpleString()
            col = F.col(name)
            if kind in ("double", "float"):
                picked.append((F.round(col.cast("double"), rounded.get(name, 6)) + F.lit(0.0)).alias(name))
            elif kind == "boolean":
                picked.append(col.cast("int").alias(name))
            elif kind in ("timestamp", "timestamp_ntz"):
                picked.append(micros(name).alias(name))
            else:
                picked.append(col)
        else:
            picked.append(c)
    return df.select(*picked)


H = HOUR
SQL_TICKS = """
ticks AS (
  SELECT event_type AS symbol, epoch_us(ts) AS us, value, user_id, event_id, props FROM events
)"""

SQL_BARS = SQL_TICKS + f""",
raw_bars AS (
  SELECT symbol, ((us + {H - 1}) // {H}) * {H} AS ts_us,
         arg_min(value, (us, event_id)) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, (us, event_id)) AS close, CAST(sum(user_id) AS DOUBLE) AS volume
  FROM ticks GROUP BY 1, 2
),
bars AS (
  SELECT b.* FROM raw_bars b
  JOIN (SELECT symbol, min(us) AS f FROM ticks GROUP BY 1) m USING (symbol)
  WHERE b.ts_us > (m.f // {DAY}) * {DAY}
)"""

SQL_DAILY = f"""
orderticks AS (
  SELECT o_orderpriority AS symbol, epoch_us(o_orderdate) AS us, o_totalprice AS value, o_orderkey AS event_id FROM orders
),
raw_daily AS (
  SELECT symbol, ((us + {DAY - 1}) // {DAY}) * {DAY} AS ts_us,
         arg_min(value, (us, event_id)) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, (us, event_id)) AS close, CAST(count(*) AS DOUBLE) AS volume
  FROM orderticks GROUP BY 1, 2
),
daily AS (
  SELECT b.* FROM raw_daily b
  JOIN (SELECT symbol, min(us) AS f FROM orderticks GROUP BY 1) m USING (symbol)
  WHERE b.ts_us > (m.f // {DAY}) * {DAY}
)"""


def r(expr: str, name: str, digits: int = 6) -> str:
    """Rounded output column of an oracle (adding 0 turns -0.0 into 0.0)."""
    return f"round(CAST({expr} AS DOUBLE), {digits}) + 0.0 AS {name}"
