"""Composite job: causal features from bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.functions.scalars import clean_numeric, finite, hour_of_week, range_ratio, safe_log1p, safe_log_ratio
from tsforge.operators.causal import winsor_zscores_in
from tsforge.operators.layout import Axis, chunk_window, chunked, over_frames, owned
from tsforge.operators.quality import assert_unique

# The columns of the feature table, in order.
FEATURES = [
    "ret_5m",
    "ret_1h",
    "ret_4h",
    "hl_range",
    "co_ret",
    "vol_z",
    "oi_z",
    "fund_now_z",
    "funding_pctile_30d",
    "cvd_perp_5m",
    "cvd_diff_z",
    "perp_share_60m",
    "liq60_z",
    "rv_5m_z",
    "hour_of_week_sin",
    "hour_of_week_cos",
]
FLAGS = ["_imputed_funding_now", "_imputed_oi_now"]

# The measures a bar table may bring.
MEASURES = [
    "open",
    "high",
    "low",
    "close",
    "volume",
    "funding_now",
    "funding_pctile_30d",
    "oi_now",
    "cvd_perp_5m",
    "perp_share_60m",
    "liq_notional_60m",
    "rv_5m",
]


def feature_reach(window: int, fill_limit: int = 3) -> int:
    """Earlier rows that the features of a row depend on: a z-score over clipped values, each over its own past."""
    return 2 * window + 2 + max(48, fill_limit)


def build_features(
    bars: DataFrame,
    axis: Axis,
    warmup: int = 8640,
    low: float = 0.01,
    high: float = 0.99,
    fill_limit: int = 3,
    keep: tuple[str, ...] = (),
    window: int | None = None,
    check_keys: bool = False,
) -> DataFrame:
    """16 features and 2 imputation flags per bar, from the current and earlier bars only.

    All row frames share one partitioning and one order, so the bars are shuffled and
    sorted once; the six winsorised z-scores are computed on the same chunks. The first
    ``warmup`` bars of each key are dropped; ``window`` is the reach of the z-scores
    (the warm-up length unless given).
    """
    window = window or warmup
    have = set(bars.columns)
    base = bars.select(
        *axis.keys,
        axis.ts,
        *axis.ties,
        *[F.col(c).cast("double").alias(c) if c in have else F.lit(None).cast("double").alias(c) for c in MEASURES],
        *[c for c in keep if c not in MEASURES],
    )
    if check_keys:
        assert_unique(base, [*axis.keys, axis.ts])
    pieces = chunked(base, axis, back=feature_reach(window, fill_limit))
    w = chunk_window(axis)
    filled = lambda c: F.last(c, ignorenulls=True).over(w.rowsBetween(-fill_limit, 0))
    sin, cos = hour_of_week(axis.ts)
    d = pieces.withColumns(
        {
            "ret_5m": safe_log_ratio("close", F.lag("close").over(w)),
            "_fund": filled("funding_now"),
            "_oi": filled("oi_now"),
            "_cvd_diff": F.col("cvd_perp_5m") - F.lag("cvd_perp_5m").over(w),
            "_pos": F.col("_base") + F.row_number().over(w) - 1,
        }
    ).withColumns(
        {
            "ret_1h": F.sum("ret_5m").over(w.rowsBetween(-11, 0)),
            "ret_4h": F.sum("ret_5m").over(w.rowsBetween(-47, 0)),
            "hl_range": range_ratio("high", "low", "close"),
            "co_ret": safe_log_ratio("close", "open"),
            "_vol": safe_log1p("volume"),
            "_oi_log": safe_log1p("_oi"),
            "_liq": safe_log1p("liq_notional_60m"),
            "hour_of_week_sin": sin,
            "hour_of_week_cos": cos,
            "_imputed_funding_now": (F.col("funding_now").isNull() & F.col("_fund").isNotNull()).cast("int"),
            "_imputed_oi_now": (F.col("oi_now").isNull() & F.col("_oi").isNotNull()).cast("int"),
            "perp_share_60m": finite("perp_share_60m"),
        }
    )
    scores = {"_vol": "vol_z", "_oi_log": "oi_z", "_fund": "fund_now_z", "_cvd_diff": "cvd_diff_z", "_liq": "liq60_z", "rv_5m": "rv_5m_z"}
    wanted = [*axis.keys, axis.ts, *axis.ties, *keep, *FLAGS, *[f for f in FEATURES if f not in scores.values()], *scores]
    internal = ["_chunk", "_own", "_us", "_pos"]
    d = winsor_zscores_in(d.select(*dict.fromkeys([*wanted, *internal])), axis, scores, window, low, high)
    d = owned(d).where(F.col("_pos") >= warmup)
    d = d.select(*axis.keys, axis.ts, *FEATURES, *FLAGS, *[c for c in keep if c not in FEATURES])
    return clean_numeric(d, exclude=(*axis.keys, axis.ts, *keep))


def latest_features(bars: DataFrame, axis: Axis, window: int = 144, **options) -> DataFrame:
    """Features of the newest bar of each key, as the batch build gives them; a missing one falls back to the bar before.

    Only as many of the newest bars are read as the features of two bars depend on.
    """
    from tsforge.operators.causal import tail_per_key

    recent = tail_per_key(bars, axis, feature_reach(window, options.get("fill_limit", 3)) + 2)
    feats = build_features(recent, axis, warmup=0, window=window, **options)

    def build(d: DataFrame, w) -> DataFrame:
        return d.withColumns({f: F.coalesce(F.col(f), F.lag(f).over(w)) for f in FEATURES})

    return tail_per_key(over_frames(feats, axis, build, back=1), axis, 1)
