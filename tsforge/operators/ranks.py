"""Order statistics by value -- ranks, running distributions, exact quantiles -- of large groups.

Sorting a whole group in one task fails when one group holds much of the data.

* Ranks and running sums first add up equal values, so that a value half of all rows share is
  one row; the distinct values are range-partitioned by (group, value), which cuts by rank and not by
  width, and each range starts from the exact totals of the ranges below it.
* Quantiles need no sort and no exchange of rows: a mergeable quantile sketch gives 64 cells per group,
  each cell is split evenly into counting buckets (more of them for larger groups), and one partially
  aggregated count per bucket names the few that hold the wanted positions. Only their rows are
  looked at. A wanted bucket that still holds many values, as beside an outlier, is sketched and
  counted again by itself. The sketch only balances the work; the counts make the result exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsforge.session import measured

CELLS = 64
FINE_LIMIT = 16_384
CHUNK_VALUES = 262_144


def _grouped(df: DataFrame, by: list[str], value: str) -> tuple[DataFrame, list[str]]:
    if not by:
        df, by = df.withColumn("_all", F.lit(0)), ["_all"]
    return df.where(F.col(value).isNotNull()), by


def _sketch(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, _t rows, _q cell boundaries), one small row per group, from one scan."""
    probs = F.expr(f"array({', '.join(f'{i / CELLS}D' for i in range(CELLS + 1))})")
    return measured(
        rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_t"), F.percentile_approx(value, probs, F.lit(2_000)).alias("_q"))
    )


def _fineness(longest: int, chunk_values: int) -> int:
    """Buckets per cell, so that a bucket of the largest group holds about 1/16 of a chunk."""
    return int(min(max(16 * longest / (CELLS * chunk_values), 16), FINE_LIMIT))


def _place(rows: DataFrame, sketch: DataFrame, by: list[str], value: str, fine: int) -> DataFrame:
    """Add ``_bucket``, a monotone number of the value: its quantile cell, then an even split of the cell.

    One expression: a binary search over the cell boundaries whose last step splits the
    cell. (Separate columns would be inlined into each other many times over.)
    """
    steps, step = [], CELLS // 2
    while step:
        steps.append(F.lit(step))
        step //= 2
    v = F.col(value).cast("double")

    def split(cell: Column) -> Column:
        lo, hi = F.get("_q", cell), F.get("_q", cell + 1)
        part = F.floor(F.coalesce(F.try_divide(v - lo, hi - lo), F.lit(0.0)) * fine)
        return cell.cast("long") * fine + F.least(F.greatest(part, F.lit(0)), F.lit(fine - 1))

    search = F.aggregate(
        F.array(*steps), F.lit(0), lambda cell, step: F.when(F.get("_q", cell + step) <= v, cell + step).otherwise(cell), split
    )
    # Never NULL, and said so: otherwise a join on it would first evaluate it once more as a filter.
    return rows.join(sketch.drop("_t"), by).withColumn("_bucket", F.coalesce(search, F.lit(0).cast("long"))).drop("_q")


def _before(name: str) -> str:
    return "before" if name == "n" else f"before_{name}"


def value_chunks(rows: DataFrame, keys: list[str], value: str, sums: dict[str, Column], chunk_values: int) -> DataFrame:
    """(keys, value, sums, _chunk, _before_*, _whole_*): distinct values in ranges of about ``chunk_values``.

    ``_before_*`` are the sums of the group below the range, ``_whole_*`` those of the group.
    """
    distinct = measured(rows.groupBy(*keys, value).agg(*[F.sum(c).cast("double").alias(name) for name, c in sums.items()]))
    parts = -(-distinct.count() // chunk_values)
    if parts > 1:
        distinct = measured(distinct.repartitionByRange(parts, *keys, value).withColumn("_chunk", F.spark_partition_id()))
    else:
        distinct = distinct.withColumn("_chunk", F.lit(0))
    totals = distinct.groupBy(*keys, "_chunk").agg(*[F.sum(s).alias(f"_sum_{s}") for s in sums])
    below = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = {f"_before_{s}": F.coalesce(F.sum(f"_sum_{s}").over(below), F.lit(0.0)) for s in sums}
    whole = {f"_whole_{s}": F.sum(f"_sum_{s}").over(Window.partitionBy(*keys)) for s in sums}
    layout = measured(totals.withColumns({**before, **whole}).drop(*[f"_sum_{s}" for s in sums]))
    return distinct.join(layout, [*keys, "_chunk"])


def running_by_value(
    df: DataFrame, by: list[str], value: str, weights: dict[str, str] | None = None, chunk_values: int = CHUNK_VALUES, totals: bool = False
) -> DataFrame:
    """(by, value, n, before[, weight sums and their before_*]) per distinct non-null value.

    ``before`` counts the rows of the group with a smaller value; with ``totals`` there are also the
    sums over the group, as whole_*.
    """
    rows, keys = _grouped(df, by, value)
    sums = {"n": F.lit(1), **{name: F.col(c) for name, c in (weights or {}).items()}}
    d = value_chunks(rows, keys, value, sums, chunk_values)
    w = Window.partitionBy(*keys, "_chunk").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumns({_before(s): F.col(f"_before_{s}") + F.coalesce(F.sum(s).over(w), F.lit(0.0)) for s in sums})
    return d.select(*by, value, *sums, *[_before(s) for s in sums], *[F.col(f"_whole_{s}").alias(f"whole_{s}") for s in sums if totals])


def exact_quantiles(df: DataFrame, by: list[str], value: str, probs: list[float], chunk_values: int = CHUNK_VALUES) -> DataFrame:
    """(by, prob, quantile): linear interpolation between order statistics, as numpy does."""
    rows, keys = _grouped(df, by, value)
    rows = rows.select(*keys, value)
    sketch = _sketch(rows, keys, value)
    wanted = sketch.withColumn("prob", F.explode(F.array(*[F.lit(p) for p in probs])))
    wanted = wanted.select(*keys, "prob", (F.col("prob") * (F.col("_t") - 1)).alias("_at"))
    ends = F.explode(F.array(F.floor("_at"), F.ceil("_at")).cast("array<bigint>"))
    places = measured(wanted.withColumn("_pos", ends).distinct())
    d = _values_at(rows, sketch, keys, value, places, chunk_values)
    picked = d.groupBy(*keys, "prob", "_at").agg(F.min_by(value, "_pos").alias("_lo"), F.max_by(value, "_pos").alias("_hi"))
    frac = F.col("_at") - F.floor("_at")
    return picked.select(*by, "prob", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * frac).alias("quantile"))


def values_at(df: DataFrame, by: list[str], value: str, positions: list[int], chunk_values: int = CHUNK_VALUES) -> DataFrame:
    """(by, pos, value): the values at given zero-based positions of each sorted group."""
    rows, keys = _grouped(df, by, value)
    rows = rows.select(*keys, value)
    sketch = _sketch(rows, keys, value)
    asked = F.explode(F.array(*[F.lit(p).cast("long") for p in sorted(set(positions))]))
    places = measured(sketch.select(*keys, asked.alias("_pos")))
    return _values_at(rows, sketch, keys, value, places, chunk_values).select(*by, F.col("_pos").alias("pos"), value)


def wanted_buckets(rows: DataFrame, sketch: DataFrame, keys: list[str], value: str, places: DataFrame, chunk_values: int) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Rows of the buckets that hold an asked position, with ``_bucket`` and ``_start``: in buckets of a bounded
    size, and, if there are any, in larger ones of several values; and the places in the latter."""
    longest = sketch.agg(F.max("_t")).first()[0] or 0
    if longest <= chunk_values:
        return rows.withColumns({"_bucket": F.lit(0).cast("long"), "_start": F.lit(0).cast("long")}), None, None
    rows = _place(rows, sketch, keys, value, _fineness(longest, chunk_values))
    counts = rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"), (F.min(value) < F.max(value)).alias("_mixed"))
    upto = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("_end", F.sum("_n").over(upto)).withColumn("_start", F.col("_end") - F.col("_n"))
    hit = counts.join(places, keys).where((F.col("_pos") >= F.col("_start")) & (F.col("_pos") < F.col("_end")))
    large = (F.col("_n") > chunk_values) & F.col("_mixed")
    hit = measured(hit.select(*keys, "_bucket", "_start", "_end", large.alias("_large")).distinct())
    found = rows.join(hit.drop("_end"), [*keys, "_bucket"])
    small = found.where(~F.col("_large")).drop("_large")
    if not hit.where("_large").limit(1).count():
        return small, None, None
    inside = places.join(hit.where("_large"), keys).where((F.col("_pos") >= F.col("_start")) & (F.col("_pos") < F.col("_end")))
    return small, found.where("_large").drop("_large"), inside.drop("_end", "_large")


def _values_at(rows: DataFrame, sketch: DataFrame, keys: list[str], value: str, places: DataFrame, chunk_values: int) -> DataFrame:
    """``places`` with the value at each position: only ranges that hold an asked position are looked at."""
    small, large, inside = wanted_buckets(rows, sketch, keys, value, places, chunk_values)
    distinct = small.groupBy(*keys, "_bucket", "_start", value).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    d = distinct.withColumn("_end", F.col("_start") + F.sum("_n").over(w))
    out = d.join(places, keys).where((F.col("_pos") < F.col("_end")) & (F.col("_pos") >= F.col("_end") - F.col("_n")))
    out = out.select(*places.columns, value)
    if large is None:
        return out
    # A bucket that is still too large is a group of its own, with positions counted from its start.
    deep = [*keys, "_in"]
    again = measured(large.select(*keys, F.struct("_bucket", "_start").alias("_in"), value))
    asked = measured(inside.select(*[c for c in places.columns if c != "_pos"], F.struct("_bucket", "_start").alias("_in"), (F.col("_pos") - F.col("_start")).alias("_pos")))
    found = _values_at(again, _sketch(again, deep, value), deep, value, asked, chunk_values)
    return out.unionByName(found.withColumn("_pos", F.col("_pos") + F.col("_in._start")).select(*out.columns))


def pct_rank(df: DataFrame, by: list[str], value: str, out: str, chunk_values: int = CHUNK_VALUES) -> DataFrame:
    """Average-tie percentile rank in (0, 1] of each row among all rows of its group."""
    ranked = running_by_value(df, by, value, chunk_values=chunk_values)
    total = measured(df.groupBy(*by).agg(F.count(value).alias("_t")))
    ranks = ranked.join(total, by).select(
        *by, value, ((F.col("before") + (F.col("n") + 1) / 2) / F.col("_t")).alias(out)
    )
    return df.join(ranks, [*by, value], "left")


def ks_two_sample(a: DataFrame, b: DataFrame, cols: list[str], chunk_values: int = CHUNK_VALUES) -> DataFrame:
    """(feature, d, p, n_a, n_b): two-sample Kolmogorov-Smirnov for all columns at once."""

    def long(df: DataFrame, tag: int) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols])
        return df.select(F.explode(pairs).alias("x")).select(
            "x.feature", "x.v", F.lit(1 - tag).alias("is_a"), F.lit(tag).alias("is_b")
        )

    ranked = running_by_value(long(a, 0).unionByName(long(b, 1)), ["feature"], "v", {"na": "is_a", "nb": "is_b"}, chunk_values, totals=True)
    d = ranked.withColumnsRenamed({"whole_na": "n_a", "whole_nb": "n_b"})
    gap = F.abs(
        F.try_divide(F.col("before_na") + F.col("na"), F.col("n_a")) - F.try_divide(F.col("before_nb") + F.col("nb"), F.col("n_b"))
    )
    out = d.groupBy("feature", "n_a", "n_b").agg(F.coalesce(F.max(gap), F.lit(0.0)).alias("d"))
    ne = F.try_divide(F.col("n_a") * F.col("n_b"), F.col("n_a") + F.col("n_b"))
    empty = (F.col("n_a") == 0) | (F.col("n_b") == 0)
    p = F.when(empty, 1.0).otherwise(F.least(F.lit(1.0), 2.0 * F.exp(-2.0 * ne * F.col("d") * F.col("d"))))
    return out.select("feature", F.when(empty, 0.0).otherwise(F.col("d")).alias("d"), p.alias("p"), F.col("n_a").cast("long").alias("n_a"), F.col("n_b").cast("long").alias("n_b"))
