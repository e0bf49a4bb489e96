"""Triple-barrier labels and fixed-length sequence windows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.functions.scalars import encode_label, numeric_columns
from tsforge.operators.causal import atr_pct_in, atr_reach
from tsforge.operators.layout import Axis, chunk_window, chunked, over_pandas, owned
from tsforge.operators.touch import Maxima, first_at_most


def triple_barrier(
    df: DataFrame, axis: Axis, k: float = 1.2, H: int = 36, atr_window: int = 14, drop_warmup: bool = False
) -> DataFrame:
    """Label each bar by which of close*(1 +- k*ATR%) the next H bars touch first.

    Rows without H following bars are dropped. With ``drop_warmup`` so are the first bars,
    whose range statistic is not complete yet.
    """
    pieces = chunked(df.select(*axis.keys, axis.ts, "open", "high", "low", "close"), axis, atr_reach(atr_window), H)
    d = atr_pct_in(pieces, axis, atr_window, "_atr")
    width = F.lit(k) * F.col("_atr")
    d = d.withColumns({"tp_px": F.col("close") * (1.0 + width), "sl_px": F.col("close") * (1.0 - width)})

    def touch(rows: pd.DataFrame) -> pd.DataFrame:
        """What the barriers of every row meet first among the H rows after it, by halving steps over all rows at once."""
        n = len(rows)
        open_, high, low, tp, sl = (rows[c].to_numpy(dtype=float) for c in ("open", "high", "low", "tp_px", "sl_px"))
        row = np.arange(n)
        up = Maxima(np.fmax(open_, high)).first_at_least(row + 1, tp)
        down = first_at_most(Maxima(-np.fmin(open_, low)), row + 1, sl)
        in_time = np.minimum(up, down) <= row + H
        label = np.where(in_time & (up < down), "LONG", np.where(in_time & (down < up), "SHORT", "WAIT"))
        end = np.where(row + H < n, rows["_us"].to_numpy()[np.minimum(row + H, n - 1)], -1)
        return pd.DataFrame({"label": label, "_until": end, "_pos": rows["_base"].to_numpy() + row})

    d = owned(over_pandas(d, axis, touch, {"label": "string", "_until": "long", "_pos": "long"}))
    d = d.where((F.col("_until") >= 0) & F.col("tp_px").isNotNull() & F.col("sl_px").isNotNull())
    if drop_warmup:
        d = d.where(F.col("_pos") > atr_window)
    until = F.timestamp_micros("_until").cast(df.schema[axis.ts].dataType)
    return d.select(*axis.keys, axis.ts, "label", "tp_px", "sl_px", until.alias("timeout_ts"))


def label_mismatch(labels: DataFrame, bars: DataFrame, axis: Axis, H: int = 36, sample: int | None = None, seed: int = 42) -> DataFrame:
    """Recompute labels from their barriers, bar by bar after each label; one row (checked, mismatches, ratio).

    An independent second implementation: the H following bars are looked at one step after the
    other, for all labels of a chunk together. Rows travel once, in chunks with H bars after them.
    """
    lab = labels.select(*axis.keys, axis.ts, F.col("label").alias("_label"), "tp_px", "sl_px")
    if sample is not None:
        lab = sample_rows(lab, [*axis.keys, axis.ts], sample, seed)
    rows = bars.select(*axis.keys, axis.ts, "open", "high", "low").join(lab, [*axis.keys, axis.ts], "left")

    def again(rows: pd.DataFrame) -> pd.DataFrame:
        top = np.fmax(rows["open"].to_numpy(dtype=float), rows["high"].to_numpy(dtype=float))
        bottom = np.fmin(rows["open"].to_numpy(dtype=float), rows["low"].to_numpy(dtype=float))
        tp, sl = rows["tp_px"].to_numpy(dtype=float), rows["sl_px"].to_numpy(dtype=float)
        found, left = np.full(len(rows), "WAIT", dtype=object), rows["_label"].notna().to_numpy()
        for step in range(1, min(H, len(rows) - 1) + 1):
            at = np.flatnonzero(left[:-step])
            up, down = top[at + step] >= tp[at], bottom[at + step] <= sl[at]
            found[at[up & ~down]], found[at[down & ~up]] = "LONG", "SHORT"
            left[at[up | down]] = False
        return pd.DataFrame({"_again": found})

    checked = owned(over_pandas(chunked(rows, axis, ahead=H), axis, again, {"_again": "string"})).where("_label IS NOT NULL")
    n, bad = F.count(F.lit(1)), F.count_if(F.col("_again") != F.col("_label"))
    return checked.agg(n.alias("checked"), bad.alias("mismatches"), F.coalesce(F.try_divide(bad, n), F.lit(0.0)).alias("ratio"))


def sample_rows(df: DataFrame, keys: list[str], n: int, seed: int = 42) -> DataFrame:
    """n rows chosen by a hash of their key: the same rows whatever the partitioning."""
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.orderBy(draw, *keys).limit(n)


def sequence_windows(
    features: DataFrame,
    labels: DataFrame,
    axis: Axis,
    W: int,
    every: int,
    cols: list[str] | None = None,
    flat: bool = False,
) -> DataFrame:
    """(key, ts, window, label, y): the W bars ending at each labelled time, without gaps.

    Arrays multiply the data by W, so they are built last and kept only for labelled rows.
    """
    cols = cols or numeric_columns(features, (*axis.keys, axis.ts, "label"))
    wanted = labels.select(*axis.keys, F.col(axis.ts).cast("timestamp").alias(axis.ts), "label")
    rows = features.select(*axis.keys, F.col(axis.ts).cast("timestamp").alias(axis.ts), *cols)
    rows = rows.join(wanted, [*axis.keys, axis.ts], "left")
    w = chunk_window(axis)
    frame = w.rowsBetween(-(W - 1), 0)
    vector = F.array(*[F.col(c).cast("double") for c in cols])
    d = chunked(rows, axis, back=W - 1).withColumns(
        {"window": F.collect_list(vector).over(frame), "_from": F.min("_us").over(frame), "_at": F.col("_us")}
    )
    d = owned(d).where(
        F.col("label").isNotNull() & (F.size("window") == W) & (F.col("_at") - F.col("_from") == (W - 1) * every)
    )
    window = F.flatten("window") if flat else F.col("window")
    return d.select(*axis.keys, axis.ts, window.alias("window"), "label", encode_label("label").alias("y"))


