import numpy as np
import pandas as pd

from tsforge.functions.timeunits import MINUTE
from tsforge.operators.layout import Axis

AXIS = Axis("symbol", "ts", bucket_us=60 * MINUTE)
FIVE = 5 * MINUTE


def walk(rows=300, symbols=("A", "B"), seed=0, gaps=False):
    """Random-walk OHLC bars at 5 minutes."""
    out = []
    for i, s in enumerate(symbols):
        rng = np.random.default_rng(seed + i)
        close = 100 + np.cumsum(rng.normal(0, 0.3, rows))
        open_ = np.r_[100, close[:-1]]
        pdf = pd.DataFrame(
            {
                "symbol": s,
                "ts": pd.date_range("2024-01-01", periods=rows, freq="5min"),
                "open": open_,
                "high": np.maximum(open_, close) + rng.random(rows) * 0.2,
                "low": np.minimum(open_, close) - rng.random(rows) * 0.2,
                "close": close,
                "volume": rng.integers(1, 100, rows).astype(float),
            }
        )
        out.append(pdf.drop(index=rng.choice(rows, rows // 10, replace=False)) if gaps else pdf)
    return pd.concat(out, ignore_index=True)


def pull(df, *order):
    return df.toPandas().sort_values(list(order) or ["symbol", "ts"]).reset_index(drop=True)
