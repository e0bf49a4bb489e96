"""Composite jobs: bar lakes from landed sources."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.functions.scalars import safe_log_ratio, to_number
from tsforge.functions.timeunits import DAY, HOUR, MINUTE
from tsforge.operators.align import ffill_limit, first_source, join_measures, resample_last, resample_ohlcv, resample_sum
from tsforge.operators.causal import cumulative, rolling_pctile, rolling_time, share_of
from tsforge.operators.layout import Axis, over_frames
from tsforge.operators.quality import assert_unique
from tsforge.session import cut_lineage


@dataclass
class BarSources:
    """Typed records per source; optional ones may be missing. ``funding`` lists sources by preference."""

    price: DataFrame
    open_interest: DataFrame | None = None
    funding: tuple[DataFrame, ...] = ()
    taker: DataFrame | None = None
    spot_taker: DataFrame | None = None
    perp_taker: DataFrame | None = None
    liquidation: DataFrame | None = None


TAKER = ["taker_buy_usd", "taker_sell_usd"]


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}_{c}" for c in TAKER})


def build_bars(sources: BarSources, axis: Axis, every: int = 5 * MINUTE, fill_limit: int = 3, fill_zero: bool = True) -> DataFrame:
    """Bars joined with every measure on (key, bar).

    Open interest is the last value per bar, volumes and liquidations are sums, open
    interest and funding are carried forward at most ``fill_limit`` bars with flags.
    """
    on = [*axis.keys, axis.ts]
    base = resample_ohlcv(sources.price, axis, every, volume="volume_usd")
    pieces = []
    if sources.open_interest is not None:
        last = resample_last(sources.open_interest, axis, every, ["oi_now"])
        pieces.append(ffill_limit(last, axis.with_(ties=()), ["oi_now"], fill_limit, every, flag="_imputed_{}"))
    if sources.funding:
        funding = first_source(list(sources.funding), axis.keys)
        pieces.append(ffill_limit(funding, axis, ["funding_now"], fill_limit, every, flag="_imputed_{}"))
    if sources.taker is not None:
        pieces.append(resample_sum(sources.taker, axis, every, TAKER))
    if sources.spot_taker is not None:
        pieces.append(_prefixed(resample_sum(sources.spot_taker, axis, every, TAKER), "spot"))
    if sources.perp_taker is not None:
        pieces.append(_prefixed(resample_sum(sources.perp_taker, axis, every, TAKER), "perp"))
    if sources.liquidation is not None:
        liq = resample_sum(sources.liquidation, axis, every, ["notional_usd"])
        pieces.append(liq.withColumnRenamed("notional_usd", "liq_notional_raw"))
    bars = join_measures(base, pieces, on)
    if fill_zero:
        flags = [c for c in bars.columns if c.startswith("_imputed")]
        numbers = [c for c in bars.columns if c not in on and c not in flags]
        filled = {c: to_number(c) for c in numbers}
        filled |= {c: F.coalesce(F.col(c), F.lit(False)).cast("int") for c in flags}
        bars = bars.withColumns(filled)
    return assert_unique(cut_lineage(bars), on)


def compose_measures(bars: DataFrame, axis: Axis, suffix: str = "15m", pctile_span: int = 30 * DAY) -> DataFrame:
    """Add realised variance, cumulative volume delta, perp share, liquidations and 30-day percentiles."""
    have, axis = set(bars.columns), axis.with_(ties=())
    zero = F.lit(0.0)

    def col(name: str):
        return F.coalesce(F.col(name).cast("double"), zero) if name in have else zero

    def build(d: DataFrame, w) -> DataFrame:
        return d.withColumn(f"rv_{suffix}", F.pow(safe_log_ratio("close", F.lag("close").over(w)), F.lit(2.0)))

    d = over_frames(bars, axis, build, back=1)
    d = d.withColumns(
        {
            "_net": col("taker_buy_usd") - col("taker_sell_usd"),
            "_perp": col("perp_taker_buy_usd") + col("perp_taker_sell_usd"),
            "_spot": col("spot_taker_buy_usd") + col("spot_taker_sell_usd"),
            "_liq": col("liq_notional_raw"),
        }
    )
    d = cut_lineage(cumulative(d, axis, {"_net": f"cvd_perp_{suffix}"}))
    d = share_of(d, axis, "_perp", "_spot", "perp_share_60m", HOUR)
    d = cut_lineage(rolling_time(d, axis, {"_liq": "liq_notional_60m"}, HOUR).drop("_net", "_perp", "_spot", "_liq"))
    ranks = {c: f"{p}_pctile_30d" for c, p in (("oi_now", "oi"), ("funding_now", "funding")) if c in have}
    return rolling_pctile(d, axis, ranks, pctile_span) if ranks else d


def taker_ratio(bars: DataFrame, buy: str = "spot_taker_buy_usd", sell: str = "spot_taker_sell_usd", out: str = "spot_taker_ratio") -> DataFrame:
    """Buy share of taker volume, 0 without volume."""
    return bars.withColumn(out, F.coalesce(F.try_divide(F.col(buy), F.col(buy) + F.col(sell)), F.lit(0.0)))
