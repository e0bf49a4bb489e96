"""Landed vendor JSON to typed records.

A landing table has one JSON document per row. The record list may sit at several places
of the document; it is parsed once as a variant, the candidate lists are scored by how
many typical bar fields their first record has, and the best one is exploded.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsforge.functions.scalars import to_utc

# Places where a record list may sit, in order of preference.
LIST_PATHS = ["$", "$.data", "$.list", "$.rows", "$.result", "$.data.list", "$.data.rows", "$.data.result"]

# Field names that mark a list of bars.
MARKER_FIELDS = ["t", "ts", "timestamp", "o", "open", "c", "close"]

# Accepted spellings of the fields of each record type.
TIME_ALIASES = ["time", "t", "ts", "timestamp"]


@dataclass(frozen=True)
class RecordSpec:
    """Output field -> accepted source fields; ``defaults`` marks optional fields.

    ``numbers``: output column -> source field of a whole number that only comes along, null if absent, such as a
    record's own id, by which records of one time can be ordered.
    """

    fields: dict[str, list[str]]
    defaults: dict[str, float] = field(default_factory=dict)
    time: tuple[str, ...] = tuple(TIME_ALIASES)
    numbers: dict[str, str] = field(default_factory=dict)


PRICE = RecordSpec(
    {
        "open": ["o", "open"],
        "high": ["h", "high"],
        "low": ["l", "low"],
        "close": ["c", "close"],
        "volume_usd": ["v", "volume", "volume_usd", "volumeUsd", "volume_usdt"],
    },
    {"volume_usd": 0.0},
)
OPEN_INTEREST = RecordSpec({"oi_now": ["c", "close", "oi"]})
FUNDING = RecordSpec({"funding_now": ["f", "funding", "fundingRate", "value"]})
TAKER_VOLUME = RecordSpec(
    {
        "taker_buy_usd": ["buy", "buy_usd", "taker_buy_usd", "buyVolumeUsd", "buy_volume_usd", "buyUsd"],
        "taker_sell_usd": ["sell", "sell_usd", "taker_sell_usd", "sellVolumeUsd", "sell_volume_usd", "sellUsd"],
    },
    {"taker_buy_usd": 0.0, "taker_sell_usd": 0.0},
)
LIQUIDATION = RecordSpec({"notional_usd": ["notional", "value", "amountUsd"]})
SPECS = {
    "price": PRICE,
    "open_interest": OPEN_INTEREST,
    "funding": FUNDING,
    "taker_volume": TAKER_VOLUME,
    "liquidation": LIQUIDATION,
}


def find_records(raw: DataFrame, payload: str) -> DataFrame:
    """Explode the best record list of each document into a variant column ``record``."""
    doc = raw.withColumn("_doc", F.try_parse_json(payload))
    lists = F.array(*[F.try_variant_get("_doc", path, "array<variant>") for path in LIST_PATHS])

    def score(items: Column) -> Column:
        first = F.get(items, F.lit(0))
        hits = [F.when(F.try_variant_get(first, f"$.{m}", "variant").isNotNull(), 1).otherwise(0) for m in MARKER_FIELDS]
        total = hits[0]
        for h in hits[1:]:
            total = total + h
        return total

    # Highest score first; among equals the earliest place (hence the negated index).
    ranked = F.transform(
        lists,
        lambda items, i: F.when(
            F.size(items) > 0, F.struct(score(items).alias("s"), (-i).alias("at"))
        ),
    )
    best = F.array_max(F.filter(ranked, lambda x: x.isNotNull()))
    d = doc.withColumn("_best", best).withColumn("_items", F.get(lists, -F.col("_best.at")))
    return d.withColumn("record", F.explode("_items")).drop("_doc", "_best", "_items")


def normalise_records(
    raw: DataFrame, payload: str, spec: RecordSpec, keep: list[str] | None = None, zero_is_missing: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of all records: typed columns by field alias.

    A record lacking its time or a required number goes to ``rejects`` with its JSON.
    ``zero_is_missing`` lets a zero fall through to the next alias, and a required zero
    count as missing.
    """
    keep = keep if keep is not None else [c for c in raw.columns if c != payload]
    records = find_records(raw, payload)

    def text(name: str) -> Column:
        return F.try_variant_get("record", f"$.{name}", "string")

    def number(name: str) -> Column:
        v = text(name).try_cast("double")
        return F.nullif(v, F.lit(0.0)) if zero_is_missing else v

    cols = {"ts": to_utc(F.coalesce(*[text(a) for a in spec.time]))}
    for name, aliases in spec.fields.items():
        value = F.coalesce(*[number(a) for a in aliases])
        cols[name] = F.coalesce(value, F.lit(spec.defaults[name])) if name in spec.defaults else value
    for name, source in spec.numbers.items():
        cols[name] = text(source).try_cast("bigint")
    typed = records.withColumns(cols)
    required = ["ts", *[n for n in spec.fields if n not in spec.defaults]]
    ok = F.lit(True)
    for name in required:
        ok = ok & F.col(name).isNotNull()
    good = typed.where(ok).select(*keep, *cols)
    rejects = typed.where(~ok).select(*keep, F.to_json("record").alias("record"))
    return good, rejects


def best_range(snapshots: DataFrame, keys: list[str], range_days: str = "range_days") -> DataFrame:
    """Keep, per key, the snapshots of the longest range that returned any record; drop repeats."""
    from tsforge.operators.layout import per_key

    longest = per_key(snapshots.select(*keys, range_days), keys, F.max(range_days).alias("_r"))
    d = snapshots.join(longest, keys).where(F.col(range_days) == F.col("_r")).drop("_r", range_days)
    return d.distinct()
