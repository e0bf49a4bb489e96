"""Composite jobs: labels from features and bars, decisions from probabilities and bars."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tsforge.operators.labels import triple_barrier
from tsforge.operators.layout import Axis
from tsforge.operators.policy import position_policy, with_decision_schema
from tsforge.operators.quality import assert_unique
from tsforge.session import cut_lineage
from tsforge.sources.lake import write_daily, write_decisions

OHLC = ["open", "high", "low", "close"]


def label_job(
    features: DataFrame, axis: Axis, raw: DataFrame | None = None, k: float = 1.2, H: int = 36, atr_window: int = 14, path: str | None = None
) -> DataFrame:
    """Barrier labels of a feature table; prices come from ``raw`` when the features have none.

    The keys are checked to be unique; with ``path`` the labels are written by day.
    """
    keys = [*axis.keys, axis.ts]
    rows = features
    if not set(OHLC) <= set(features.columns):
        if raw is None:
            raise ValueError("the features have no prices: give the raw bars")
        rows = features.select(*keys).join(raw.select(*keys, *OHLC), keys)
    labels = assert_unique(cut_lineage(triple_barrier(rows, axis, k, H, atr_window)), keys)
    if path:
        write_daily(labels, path, axis.keys, axis.ts, check_keys=False)
    return labels


def decision_job(bars: DataFrame, probs: DataFrame, axis: Axis, path: str | None = None, **policy) -> DataFrame:
    """Bars joined with calibrated probabilities, run through the position policy, in the fixed schema."""
    keys = [*axis.keys, axis.ts]
    rows = bars.join(probs.select(*keys, "p_long", "p_short", "p_wait"), keys)
    decided = with_decision_schema(position_policy(rows, axis, **policy))
    if path:
        decided = cut_lineage(decided)
        write_decisions(decided, path)
    return decided
