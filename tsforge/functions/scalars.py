"""Column functions. Every one stays inside JVM code generation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Class codes used by label encoding.
LABEL_CODES = {"WAIT": 0, "LONG": 1, "SHORT": 2}

# Spellings of venue names, looked up by upper case.
VENUE_NAMES = {
    "BINANCE": "Binance",
    "BYBIT": "Bybit",
    "BITGET": "Bitget",
    "BITFINEX": "Bitfinex",
    "HUOBI": "Huobi",
    "OKX": "OKX",
}


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def finite(x: Column | str) -> Column:
    """NaN and infinities become NULL."""
    v = _c(x).cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != F.lit(math.inf)), v)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Normalise NaN to NULL in every floating column (done once, at the scan)."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[F.nanvl(F.col(c), F.lit(None)).alias(c) if c in floats else F.col(c) for c in df.columns])


def clean_numeric(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Replace NULL, NaN and infinities with 0 in all floating and integer measures."""
    cols = []
    for f in df.schema.fields:
        if f.name in exclude:
            cols.append(F.col(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.coalesce(finite(f.name), F.lit(0.0)).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.IntegralType):
            cols.append(F.coalesce(F.col(f.name), F.lit(0)).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ("ts", "symbol", "label")) -> list[str]:
    """Measures chosen by type: floating and integer columns except keys and labels."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def safe_log_ratio(num: Column | str, den: Column | str) -> Column:
    n, d = _c(num).cast("double"), _c(den).cast("double")
    return F.when((n > 0) & (d > 0), F.log(F.try_divide(n, d))).otherwise(0.0)


def safe_log1p(x: Column | str) -> Column:
    v = _c(x).cast("double")
    return F.when(v.isNotNull(), F.log1p(F.greatest(v, F.lit(0.0))))


def range_ratio(high: Column | str, low: Column | str, close: Column | str) -> Column:
    return F.coalesce(finite(F.try_divide(_c(high) - _c(low), _c(close))), F.lit(0.0))


def hour_of_week(ts: Column | str) -> tuple[Column, Column]:
    """(sin, cos) of the hour of the week, Monday 00:00 = 0."""
    t = _c(ts)
    angle = F.lit(2 * math.pi) * ((F.weekday(t) * 24 + F.hour(t)) / F.lit(168.0))
    return F.sin(angle), F.cos(angle)


def to_number(x: Column | str) -> Column:
    """Coerce to double; what does not parse becomes 0."""
    return F.coalesce(F.nanvl(_c(x).try_cast("double"), F.lit(0.0)), F.lit(0.0))


def encode_label(label: Column | str) -> Column:
    lab = F.upper(_c(label))
    out = F.when(lab == "LONG", LABEL_CODES["LONG"]).when(lab == "SHORT", LABEL_CODES["SHORT"])
    return out.otherwise(LABEL_CODES["WAIT"])


def decode_label(code: Column | str) -> Column:
    c = _c(code)
    return F.when(c == 1, "LONG").when(c == 2, "SHORT").otherwise("WAIT")


def softmax(z: Column | str, temperature: Column | float = 1.0) -> Column:
    """Max-shifted softmax of an array column; the temperature is floored at 1e-6."""
    arr = _c(z)
    t = temperature if isinstance(temperature, Column) else F.lit(float(temperature))
    t = F.greatest(t, F.lit(1e-6))
    e = F.transform(arr, lambda v: F.exp((v - F.array_max(arr)) / t))
    return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, x: a + x))


def softmax3(z0: Column, z1: Column, z2: Column, temperature: Column | float = 1.0) -> tuple[Column, Column, Column]:
    """The same for three scalar columns: no arrays, so it is code-generated."""
    t = temperature if isinstance(temperature, Column) else F.lit(float(temperature))
    t = F.greatest(t, F.lit(1e-6))
    top = F.greatest(z0, z1, z2)
    e = [F.exp((z - top) / t) for z in (z0, z1, z2)]
    total = e[0] + e[1] + e[2]
    return e[0] / total, e[1] / total, e[2] / total


def logit_from_prob(p: Column | str) -> Column:
    return F.log(F.greatest(_c(p), F.lit(1e-8)))


def argmax3(p0: Column, p1: Column, p2: Column) -> Column:
    """Index of the largest of three; the first of equals wins."""
    return F.when((p0 >= p1) & (p0 >= p2), 0).when(p1 >= p2, 1).otherwise(2)


def argmax(p: Column | str) -> Column:
    arr = _c(p)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def time_decay(us: Column, us_max: Column, lam: float = 0.98) -> Column:
    """lam ** (days before the newest row)."""
    return F.pow(F.lit(lam), (us_max - us) / F.lit(86_400_000_000.0))


def dynamic_k(vol_pct: Column | str, k_min: float = 1.0, k_max: float = 1.5) -> Column:
    v = F.least(F.greatest(_c(vol_pct), F.lit(0.0)), F.lit(1.0))
    return F.lit(k_min) + F.lit(k_max - k_min) * v


def impact_bps(liq_pctile: Column | str) -> Column:
    v = F.least(F.greatest(_c(liq_pctile), F.lit(0.0)), F.lit(1.0))
    return F.lit(0.3) + F.lit(0.4) * v


def z_to_pctile(z: Column | str) -> Column:
    return F.least(F.greatest((_c(z) + 5.0) / 10.0, F.lit(0.0)), F.lit(1.0))


def decision_id(*parts: Column | str) -> Column:
    """First 16 hex digits of the SHA-256 of the parts joined by '|'."""
    return F.substring(F.sha2(F.concat_ws("|", *[_c(p) for p in parts]), 256), 1, 16)


def venue_name(x: Column | str) -> Column:
    """Canonical spelling of a venue; unknown names pass through."""
    v = _c(x)
    table = F.create_map(*[F.lit(s) for kv in VENUE_NAMES.items() for s in kv])
    return F.when(F.length(v) > 0, F.coalesce(F.element_at(table, F.upper(v)), v))


def partition_columns(ts: Column | str) -> list[Column]:
    """Day partition columns y, m, d."""
    t = _c(ts)
    return [F.date_format(t, p).alias(n) for p, n in (("yyyy", "y"), ("MM", "m"), ("dd", "d"))]


def to_utc(x: Column | str) -> Column:
    """Epoch seconds, epoch milliseconds (>= 1e12) or ISO text to a timestamp; else NULL."""
    text = _c(x).cast("string")
    number = text.try_cast("double")
    whole = F.when(F.abs(number) < 9.2e15, number.cast("long"))
    return F.coalesce(
        F.when(number >= 1e12, F.timestamp_millis(whole)),
        F.when(number.isNotNull(), F.timestamp_seconds(whole)),
        F.try_to_timestamp(text),
    )


def threshold_grid(start: float, end: float, step: float) -> list[float]:
    """start, start + step, ... up to and including end."""
    n = math.ceil((end + 1e-9 - start) / step)
    return [start + i * step for i in range(n)]


def topk_attr(attr: Column | str, n_features: int, k: int, names: list[str] | None = None) -> Column:
    """The k largest attributions by magnitude as array<struct<t, f, attr>>."""
    arr = _c(attr)
    items = F.transform(arr, lambda v, i: F.struct(F.abs(v).alias("m"), i.alias("i"), v.cast("double").alias("v")))
    # Larger magnitude first, then larger index.
    ordered = F.slice(F.reverse(F.array_sort(items)), 1, k)
    label = F.array(*[F.lit(n) for n in names]) if names else F.transform(
        F.sequence(F.lit(0), F.lit(n_features - 1)), lambda j: F.concat(F.lit("f"), j.cast("string"))
    )
    return F.transform(
        ordered,
        lambda s: F.struct(
            F.floor(s["i"] / n_features).cast("int").alias("t"),
            F.get(label, F.pmod(s["i"], F.lit(n_features))).alias("f"),
            s["v"].alias("attr"),
        ),
    )


def attr_summary(attr: Column | str) -> Column:
    """struct<sum, l1, l2, max_abs> of an attribution array."""
    arr = _c(attr)

    def fold(fn):
        return F.aggregate(arr, F.lit(0.0), lambda a, v: a + fn(v.cast("double")))

    return F.struct(
        fold(lambda v: v).alias("sum"),
        fold(F.abs).alias("l1"),
        F.sqrt(fold(lambda v: v * v)).alias("l2"),
        F.coalesce(F.array_max(F.transform(arr, lambda v: F.abs(v.cast("double")))), F.lit(0.0)).alias("max_abs"),
    )


def extract_fold_id(path: Column | str) -> Column:
    """Fold number in a file name such as fold3.parquet."""
    return F.regexp_extract(_c(path), r"fold(\d+)", 1).try_cast("int")


def extract_val_losses(line: Column | str) -> Column:
    """All val_loss=... numbers of a log line."""
    return F.transform(
        F.regexp_extract_all(_c(line), F.lit(r"val_loss=([0-9.]+)"), 1), lambda v: v.try_cast("double")
    )


def extract_lambda(line: Column | str) -> Column:
    """The decay factor written as lambda=... or λ=... in a log line."""
    return F.regexp_extract(_c(line), r"(?:lambda|λ)\s*=\s*([0-9.]+)", 1).try_cast("double")


def fallback_probs(p_long: Column | str, p_short: Column | str) -> tuple[Column, Column, Column]:
    """Two-class scores to (wait, long, short): the rest goes to wait, then renormalise."""
    pl, ps = _c(p_long), _c(p_short)
    pw = F.greatest(F.lit(0.0), 1.0 - pl - ps)
    total = pw + pl + ps
    return F.try_divide(pw, total), F.try_divide(pl, total), F.try_divide(ps, total)
