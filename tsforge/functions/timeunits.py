"""Durations in microseconds and bucket arithmetic on epoch microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def micros(ts: Column | str) -> Column:
    """Epoch microseconds of a timestamp (with or without time zone; UTC session)."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(col.cast("timestamp"))


def floor_to(us: Column, width: int) -> Column:
    return us - F.pmod(us, F.lit(width))


def ceil_to(us: Column, width: int) -> Column:
    """Right-closed, right-labelled bucket: the label of (b - width, b]."""
    return us + F.pmod(-us, F.lit(width))


def from_micros(us: Column | str) -> Column:
    return F.timestamp_micros(us)
