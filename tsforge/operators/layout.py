"""How a keyed series is cut into bounded pieces of work.

A window partitioned by the series key alone puts a whole series into one task, which
fails as soon as one key holds much of the data. Here the rows are counted per (key,
time bucket) -- a partially aggregated count that reads two columns -- and runs of
neighbouring buckets are put together into chunks of about ``chunk_rows`` rows. Each
chunk also receives the rows just before and after it (its halo) that its frames can
reach, so every frame function gives exactly the value it would give over the whole
series. The data is shuffled once, on (key, chunk).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.functions.timeunits import DAY, floor_to, micros
from tsforge.session import measured


@dataclass(frozen=True)
class Axis:
    """The key and time columns of a series and the size of its pieces.

    ``bucket_us`` is the width of the counting buckets; where one bucket of one key holds more than
    ``chunk_rows`` rows, narrower ones are counted instead. ``ties`` orders rows of equal time.
    """

    key: str | tuple[str, ...] = "symbol"
    ts: str = "ts"
    bucket_us: int = DAY
    chunk_rows: int = 65_536
    ties: tuple[str, ...] = ()

    @property
    def keys(self) -> list[str]:
        return [self.key] if isinstance(self.key, str) else list(self.key)

    def bucket(self) -> Column:
        us = micros(self.ts)
        return (floor_to(us, self.bucket_us) / F.lit(self.bucket_us)).cast("long")

    def with_(self, **changes) -> Axis:
        return replace(self, **changes)


INTERNAL = ["_bucket", "_chunk", "_own", "_base", "_us", "_end", "_total"]


def chunk_layout(
    counts: DataFrame,
    keys: list[str],
    size: int,
    back: int = 0,
    ahead: int = 0,
    back_buckets: int = 0,
    ahead_buckets: int = 0,
    sums: tuple[str, ...] = (),
) -> DataFrame:
    """Chunks and halos from a table (keys, _bucket, _n, sums...).

    Returns (keys, _bucket, _chunk, _own, _base, _end, _total, _before_*): which chunks
    need a bucket, whether they own it, the series position of the first row of the chunk,
    the positions after the bucket and after the series, and the running sums up to the
    chunk. Only bucket counts are handled here, never data rows.
    """
    size = max(size, 4 * (back + ahead), 1)
    order = Window.partitionBy(*keys).orderBy("_bucket")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    own = counts.withColumn("_end", F.sum("_n").over(upto)).withColumn("_start", F.col("_end") - F.col("_n"))
    for name in sums:
        own = own.withColumn(f"_before_{name}", F.coalesce(F.sum(f"_sum_{name}").over(before), F.lit(0.0)))
    own = own.withColumn("_chunk", F.floor(F.col("_start") / F.lit(size)).cast("long"))
    own = own.withColumn("_total", F.sum("_n").over(Window.partitionBy(*keys)))
    keep = [*keys, "_bucket", "_start", "_end", "_total", *[f"_before_{name}" for name in sums]]

    if back or ahead:
        # Two neighbouring chunks together hold at least `size` rows, so a halo of at
        # most size/4 rows reaches no further than two chunks to either side.
        up = Window.partitionBy(*keys).orderBy("_chunk").rangeBetween(Window.unboundedPreceding, -1)
        down = Window.partitionBy(*keys).orderBy(F.desc("_chunk")).rangeBetween(Window.unboundedPreceding, -1)
        own = own.withColumn("_s", F.min("_start").over(Window.partitionBy(*keys, "_chunk")))
        targets = [F.struct(F.col("_chunk").alias("c"), F.lit(True).alias("o"))]

        def target(chunk: str, needed: Column) -> Column:
            return F.when(needed, F.struct(F.col(chunk).alias("c"), F.lit(False).alias("o")))

        if ahead:
            own = own.withColumn("_p1", F.max("_chunk").over(up)).withColumn("_p1s", F.max("_s").over(up))
            own = own.withColumn("_p2", F.max("_p1").over(up))
            targets += [
                target("_p1", F.col("_p1").isNotNull() & (F.col("_start") < F.col("_s") + ahead)),
                target("_p2", F.col("_p2").isNotNull() & (F.col("_start") < F.col("_p1s") + ahead)),
            ]
        if back:
            own = own.withColumn("_n1", F.min("_chunk").over(down)).withColumn("_n1s", F.min("_s").over(down))
            own = own.withColumn("_n2", F.min("_n1").over(down)).withColumn("_n2s", F.min("_n1s").over(down))
            targets += [
                target("_n1", F.col("_n1").isNotNull() & (F.col("_end") > F.col("_n1s") - back)),
                target("_n2", F.col("_n2").isNotNull() & (F.col("_end") > F.col("_n2s") - back)),
            ]
        wanted = F.filter(F.array(*targets), lambda x: x.isNotNull())
        layout = own.withColumn("_t", F.explode(wanted)).select(
            *keep, F.col("_t.c").alias("_chunk"), F.col("_t.o").alias("_own")
        )
    else:
        layout = own.select(*keep, "_chunk", F.lit(True).alias("_own"))

    if back_buckets or ahead_buckets:
        edges = own.groupBy(*keys, "_chunk").agg(F.min("_bucket").alias("_b0"), F.max("_bucket").alias("_b1"))
        left = F.sequence(F.col("_b0") - back_buckets, F.col("_b0") - 1) if back_buckets else F.array().cast("array<bigint>")
        right = F.sequence(F.col("_b1") + 1, F.col("_b1") + ahead_buckets) if ahead_buckets else F.array().cast("array<bigint>")
        halo = edges.select(*keys, "_chunk", F.explode(F.concat(left, right)).alias("_bucket"))
        halo = halo.join(own.select(*keep), [*keys, "_bucket"]).select(*keep, "_chunk", F.lit(False).alias("_own"))
        layout = layout.unionByName(halo)

    first = Window.partitionBy(*keys, "_chunk").orderBy("_bucket")
    layout = layout.withColumn("_base", F.first("_start").over(first))
    for name in sums:
        layout = layout.withColumn(f"_before_{name}", F.first(f"_before_{name}").over(first))
    return layout.drop("_start")


HALO_BUCKETS = 20_000


def finer_bucket(axis: Axis, hottest: int, reach_us: int) -> int:
    """The bucket width at which the fullest bucket, evenly filled, holds a quarter of a chunk; at most today's.

    Counted again at that width, and again while a bucket is still too full; only rows of one
    microsecond cannot be parted. A time halo of ``reach_us`` keeps to HALO_BUCKETS buckets.
    """
    if hottest <= axis.chunk_rows:
        return axis.bucket_us
    width = axis.bucket_us // max(2, -(-4 * hottest // axis.chunk_rows))
    return min(axis.bucket_us, max(1, width, -(-reach_us // HALO_BUCKETS)))


def chunked(df: DataFrame, axis: Axis, *args, **kwargs) -> DataFrame:
    """``df`` with _chunk, _own, _base, _us (and running sums _before_*), halo rows included.

    ``back``/``ahead`` count rows, ``back_us``/``ahead_us`` microseconds.
    """
    return split(df, axis, *args, **kwargs)[0]


def split(
    df: DataFrame,
    axis: Axis,
    back: int = 0,
    ahead: int = 0,
    back_us: int = 0,
    ahead_us: int = 0,
    sums: dict[str, Column] | None = None,
) -> tuple[DataFrame, bool]:
    """The rows of :func:`chunked`, and whether any series was cut into several chunks."""
    sums = sums or {}
    rows = df.where(F.col(axis.ts).isNotNull()).withColumns({"_us": micros(axis.ts), "_bucket": axis.bucket()})
    counts = rows.groupBy(*axis.keys, "_bucket").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()]
    )
    counts = measured(counts)
    longest, hottest = counts.groupBy(*axis.keys).agg(F.sum("_n").alias("n"), F.max("_n").alias("m")).agg(F.max("n"), F.max("m")).first()
    finer = finer_bucket(axis, hottest or 0, max(back_us, ahead_us))
    if (longest or 0) > axis.chunk_rows and finer < axis.bucket_us:
        return split(df, axis.with_(bucket_us=finer), back, ahead, back_us, ahead_us, sums)
    if (longest or 0) <= axis.chunk_rows:
        # Every series fits one chunk: the key alone is a safe partitioning.
        zero = F.lit(0).cast("long")
        whole = {"_chunk": zero, "_own": F.lit(True), "_base": zero, "_end": zero, "_total": zero}
        return rows.withColumns({**whole, **{f"_before_{n}": F.lit(0.0) for n in sums}}), False
    layout = chunk_layout(
        counts,
        axis.keys,
        axis.chunk_rows,
        back,
        ahead,
        -(-back_us // axis.bucket_us),
        -(-ahead_us // axis.bucket_us),
        tuple(sums),
    )
    placed = rows.join(measured(layout), [*axis.keys, "_bucket"], "left")
    missing = F.raise_error(F.lit("a row lies in no chunk: its table changed after the chunks were laid out"))
    return placed.withColumn("_chunk", F.when(F.col("_chunk").isNotNull(), F.col("_chunk")).otherwise(missing.cast("long"))), True


def chunk_window(axis: Axis) -> WindowSpec:
    return Window.partitionBy(*axis.keys, "_chunk").orderBy("_us", *axis.ties)


def owned(df: DataFrame) -> DataFrame:
    """Drop halo rows and the working columns."""
    extra = [c for c in df.columns if c in INTERNAL or c.startswith("_before_")]
    return df.where(F.col("_own")).drop(*extra)


def over_frames(
    df: DataFrame,
    axis: Axis,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    back: int = 0,
    ahead: int = 0,
    back_us: int = 0,
    ahead_us: int = 0,
    sums: dict[str, Column] | None = None,
) -> DataFrame:
    """Run window expressions inside chunks; exact when the halo covers their reach."""
    pieces = chunked(df, axis, back, ahead, back_us, ahead_us, sums)
    return owned(build(pieces, chunk_window(axis)))


def over_pandas(
    pieces: DataFrame,
    axis: Axis,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    outputs: dict[str, str],
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """Apply ``fn`` to each time-ordered chunk; ``fn`` returns the new columns.

    ``pieces`` comes from :func:`chunked`, so a group is one bounded chunk with its halo.
    """
    kept = [f for f in pieces.schema.fields if f.name not in drop]
    schema = T.StructType([*kept, *T._parse_datatype_string(",".join(f"`{n}` {t}" for n, t in outputs.items())).fields])
    names, order = [f.name for f in kept], ["_us", *axis.ties]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable").reset_index(drop=True)
        new = fn(pdf)
        return pd.concat([pdf[names], new[list(outputs)]], axis=1)

    return pieces.groupBy(*axis.keys, "_chunk").applyInPandas(run, schema)


def with_position(df: DataFrame, axis: Axis, out: str = "pos") -> DataFrame:
    """Zero-based row position within the key, without a whole series in one task."""
    return over_frames(df, axis, lambda d, w: d.withColumn(out, F.col("_base") + F.row_number().over(w) - 1))


def per_key(df: DataFrame, keys: list[str], *aggs: Column) -> DataFrame:
    """One summary row per key, with a size Spark knows when it is joined back."""
    return measured(df.groupBy(*keys).agg(*aggs))
