"""Anomaly gates over the past of a series, and minority over-sampling."""

from __future__ import annotations

import bisect
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.functions.timeunits import DAY, micros
from tsforge.operators.folds import assign_folds
from tsforge.operators.layout import Axis, chunked, over_pandas, owned
from tsforge.operators.ranks import exact_quantiles, running_by_value
from tsforge.session import cut_lineage, measured

MIN_PAST = 32
PRODUCT_CELLS = 2_000_000  # distances a search holds at once


PANDAS_TYPES = {"string": "object", "int": "int32", "bigint": "int64", "double": "float64", "timestamp": "datetime64[ns]"}


def no_rows(schema: T.StructType) -> pd.DataFrame:
    return pd.DataFrame({f.name: pd.Series(dtype=PANDAS_TYPES.get(f.dataType.simpleString(), "object")) for f in schema.fields})


def robust_scale(df: DataFrame, by: list[str], cols: dict[str, str]) -> DataFrame:
    """(x - median) / MAD per group; a zero MAD counts as 1 and NULL becomes 0."""
    out = df
    for col, name in cols.items():
        med = measured(exact_quantiles(df, by, col, [0.5]).select(*by, F.col("quantile").alias("_med")))
        dev = df.join(med, by).select(*by, F.abs(F.col(col) - F.col("_med")).alias("_dev"))
        mad = exact_quantiles(dev, by, "_dev", [0.5]).select(*by, F.col("quantile").alias("_mad"))
        out = out.join(med, by).join(measured(mad), by)
        scale = F.when(F.col("_mad") == 0, 1.0).otherwise(F.col("_mad"))
        out = out.withColumn(name, F.coalesce((F.col(col) - F.col("_med")) / scale, F.lit(0.0))).drop("_med", "_mad")
    return out


def median_and_mad(window: list[float]) -> tuple[float, float]:
    """Median of a sorted list and the median distance to it, by merging outward from the median."""
    n = len(window)
    med = (window[(n - 1) // 2] + window[n // 2]) / 2

    def kth(k: int) -> float:
        # The k nearest values are a run of the sorted list; find where that run starts.
        lo, hi = 0, n - k
        while lo < hi:
            mid = (lo + hi) // 2
            if med - window[mid] > window[mid + k] - med:
                lo = mid + 1
            else:
                hi = mid
        return max(abs(window[lo] - med), abs(window[lo + k - 1] - med))

    low = kth((n - 1) // 2 + 1)
    return med, (low + (kth(n // 2 + 1) if n % 2 == 0 else low)) / 2


def past_robust_score(us: np.ndarray, x: np.ndarray, span_us: int) -> np.ndarray:
    """|x - median| / MAD against the rows of [t - span, t); NaN with fewer than MIN_PAST rows."""
    out = np.full(len(x), np.nan)
    window: list[float] = []
    start = 0
    for i in range(len(x)):
        while us[start] < us[i] - span_us:
            if not math.isnan(x[start]):
                del window[bisect.bisect_left(window, x[start])]
            start += 1
        if i - start >= MIN_PAST and window:
            med, mad = median_and_mad(window)
            out[i] = 0.0 if math.isnan(x[i]) else abs(x[i] - med) / (mad or 1.0)
        if not math.isnan(x[i]):
            bisect.insort(window, x[i])
    return out


def robust_gate(df: DataFrame, axis: Axis, cols: list[str], q: float = 0.995, span_us: int = 30 * DAY) -> DataFrame:
    """(key, ts, score, keep): mean robust distance to the past, kept up to the q-quantile of past scores."""
    pieces = chunked(df.select(*axis.keys, axis.ts, *axis.ties, *cols), axis, back_us=2 * span_us)

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        us = pdf["_us"].to_numpy()
        parts = [past_robust_score(us, pdf[c].to_numpy(dtype=float), span_us) for c in cols]
        score = pd.Series(np.mean(parts, axis=0), index=pd.to_datetime(us, unit="us"))
        limit = score.rolling(f"{span_us}us", min_periods=1, closed="left").quantile(q)
        keep = (score.to_numpy() <= limit.to_numpy()) | np.isnan(limit.to_numpy())
        return pd.DataFrame({"score": score.to_numpy(), "keep": keep.astype("int32")})

    scored = owned(over_pandas(pieces, axis, fn, {"score": "double", "keep": "int"}, drop=tuple(cols)))
    return scored.where(F.col("score").isNotNull() & ~F.isnan("score")).select(*axis.keys, axis.ts, "score", "keep")


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Expected depth of an unsuccessful search in a binary tree of n points."""
    n = np.asarray(n, dtype=float)
    with np.errstate(divide="ignore", invalid="ignore"):
        long = 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def grow_trees(sample: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Isolation trees over ``sample`` [trees, rows, features], all trees one level at a time.

    Returns (feature, cut, rows) per heap node of every tree; feature -1 marks a leaf.
    """
    trees, size, _ = sample.shape
    height = math.ceil(math.log2(max(size, 2)))
    nodes = 2 ** (height + 1) - 1
    dim, cut = np.full(trees * nodes, -1), np.zeros(trees * nodes)
    flat, at = sample.reshape(trees * size, -1), np.repeat(np.arange(trees) * nodes, size)
    base = at.copy()
    for _ in range(height):
        order = np.argsort(at, kind="stable")
        found, start, count = np.unique(at[order], return_index=True, return_counts=True)
        lo, hi = np.minimum.reduceat(flat[order], start), np.maximum.reduceat(flat[order], start)
        draw = np.where(hi > lo, rng.random(lo.shape), -1.0)
        pick = draw.argmax(axis=1)
        row = np.arange(len(found))
        value = lo[row, pick] + (hi - lo)[row, pick] * rng.random(len(found))
        inner = (count > 1) & (draw.max(axis=1) >= 0)
        dim[found[inner]], cut[found[inner]] = pick[inner], value[inner]
        moves = dim[at] >= 0
        right = flat[np.arange(len(at)), dim[at]] > cut[at]
        at = np.where(moves, base + 2 * (at - base) + 1 + right, at)
    rows = np.bincount(at, minlength=trees * nodes)
    return dim.reshape(trees, nodes), cut.reshape(trees, nodes), rows.reshape(trees, nodes)


def path_lengths(points: np.ndarray, dim: np.ndarray, cut: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Mean depth of each point over all trees."""
    total = np.zeros(len(points))
    place = np.arange(len(points))
    for d, c, n in zip(dim, cut, rows):
        node, depth = np.zeros(len(points), dtype=int), np.zeros(len(points))
        for _ in range(int(math.log2(len(d) + 1)) - 1):
            inner = d[node] >= 0
            right = points[place, d[node]] > c[node]
            node = np.where(inner, 2 * node + 1 + right, node)
            depth += inner
        total += depth + average_path(n[node])
    return total / len(dim)


def grow_forest(past: np.ndarray, trees: int, psi: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trees over samples of ``psi`` rows of ``past``: slices of it when it is long enough, else drawn anew."""
    rng = np.random.default_rng(seed)
    size = min(psi, len(past))
    if len(past) >= trees * psi:
        sample = past[: trees * psi].reshape(trees, psi, -1)
    else:
        sample = np.stack([past[rng.choice(len(past), size, replace=False)] for _ in range(trees)])
    return grow_trees(sample, rng)


def forest_scores(points: np.ndarray, forest: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Anomaly score of each point: near 1 when it is isolated early."""
    size = int(forest[2][0].sum())
    return 2.0 ** (-path_lengths(points, *forest) / max(float(average_path(size)), 1e-12))


def isolation_scores(past: np.ndarray, points: np.ndarray, trees: int, psi: int, seed: int) -> np.ndarray:
    """Isolation-forest anomaly score of ``points`` for a forest grown on ``past``."""
    return forest_scores(points, grow_forest(past, trees, psi, seed))


def isolation_gate(
    df: DataFrame,
    axis: Axis,
    cols: list[str],
    q: float = 0.995,
    span_us: int = 30 * DAY,
    refit_us: int = DAY,
    trees: int = 100,
    psi: int = 256,
    part_rows: int = 20_000,
    seed: int = 42,
) -> DataFrame:
    """(key, ts, score, keep) from an isolation forest refitted every ``refit_us`` on the past span.

    Trees learn from samples by nature: ``trees`` x ``psi`` rows with the least hashes of all rows
    of the past span. One forest is fitted per key and period. All rows of the span, not the
    sample, are scored with it, and a row is kept up to the q-quantile of those scores. Splits do
    not depend on a feature's scale; a missing value counts as the sample's median.
    """
    keys = axis.keys
    reach, need = -(-span_us // refit_us), trees * psi
    rows = df.select(*keys, axis.ts, *cols).withColumn("_us", micros(axis.ts)).where(F.col("_us").isNotNull())
    rows = rows.withColumn("_from", F.floor(F.col("_us") / F.lit(refit_us)).cast("long"))
    rows = rows.withColumn("_draw", F.xxhash64(*keys, "_us", *cols, F.lit(seed)))
    later = F.explode(F.sequence(F.col("_from") + 1, F.col("_from") + reach)).alias("_period")

    def least(d: DataFrame, period: str) -> DataFrame:
        order = Window.partitionBy(*keys, period).orderBy("_draw", "_us", *cols)
        return d.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= need)

    # The least draws of a span are among the least draws of its periods.
    sample = least(least(rows, "_from").drop("_r").select(*keys, "_us", "_draw", *cols, later), "_period")
    key_types = [f for f in df.schema.fields if f.name in keys]
    forests_schema = T.StructType(key_types).add("_period", "long").add("_middle", T.ArrayType(T.DoubleType())).add("_dim", "binary").add("_cut", "binary").add("_rows", "binary")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) < MIN_PAST:
            return no_rows(forests_schema)
        pdf = pdf.sort_values("_r")
        x = pdf[cols].to_numpy(dtype=float)
        middle = np.array([np.median(c[~np.isnan(c)]) if (~np.isnan(c)).any() else 0.0 for c in x.T])
        dim, cut, count = grow_forest(np.where(np.isnan(x), middle, x), trees, psi, seed + int(pdf["_period"].iloc[0]))
        parts = {"_middle": [middle.tolist()], "_dim": [dim.astype(np.int64).tobytes()], "_cut": [cut.tobytes()], "_rows": [count.astype(np.int64).tobytes()]}
        return pdf[[*keys, "_period"]].iloc[:1].assign(**parts)

    forests = measured(sample.groupBy(*keys, "_period").applyInPandas(fit, forests_schema))
    now_and_later = F.explode(F.sequence(F.col("_from"), F.col("_from") + reach)).alias("_period")
    asked = rows.select(*keys, axis.ts, "_us", "_from", *cols, now_and_later).join(forests.select(*keys, "_period"), [*keys, "_period"], "left_semi")
    sizes = asked.groupBy(*keys, "_period").agg(F.ceil(F.count(F.lit(1)) / F.lit(part_rows)).cast("int").alias("_parts"))
    sizes = measured(sizes)
    dealt = asked.join(sizes, [*keys, "_period"]).withColumn("_part", F.pmod(F.xxhash64("_us"), F.col("_parts")).cast("int"))
    models = forests.join(sizes, [*keys, "_period"]).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    schema = T.StructType([f for f in df.schema.fields if f.name in (*keys, axis.ts)]).add("_period", "long").add("_past", "boolean").add("score", "double")

    def score(model: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        if model.empty or points.empty:
            return no_rows(schema)
        m = model.iloc[0]
        dim, count = (np.frombuffer(m[c], np.int64).reshape(trees, -1) for c in ("_dim", "_rows"))
        x = points[cols].to_numpy(dtype=float)
        values = forest_scores(np.where(np.isnan(x), np.asarray(m["_middle"]), x), (dim, np.frombuffer(m["_cut"]).reshape(trees, -1), count))
        return points[[*keys, axis.ts, "_period"]].assign(_past=points["_from"] < points["_period"], score=values)

    group = [*keys, "_period", "_part"]
    scored = measured(renamed(models).groupBy(*group).cogroup(dealt.groupBy(*group)).applyInPandas(score, schema))
    limits = exact_quantiles(scored.where("_past"), [*keys, "_period"], "score", [q]).select(*keys, "_period", F.col("quantile").alias("_limit"))
    done = scored.where("NOT _past").join(measured(limits), [*keys, "_period"])
    return done.select(*keys, axis.ts, "score", (F.col("score") <= F.col("_limit")).cast("int").alias("keep"))


def mask_per_fold(gate_rows: DataFrame, folds: DataFrame, axis: Axis) -> DataFrame:
    """(key, ts, keep, fold_id): the gate for the train rows of each fold."""
    train = assign_folds(gate_rows, folds.where("split = 'train'"), axis.ts)
    return train.select(*axis.keys, axis.ts, "keep", "fold_id")


def renamed(df: DataFrame) -> DataFrame:
    """The same columns under new internal ids, so both sides of a co-group can share a source."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def _top_k(queries: pd.DataFrame, points: pd.DataFrame, k: int, vec: str) -> pd.DataFrame:
    """The k nearest points of each query by (distance, id), leaving the query itself out.

    A matrix product bounds all squared distances of a step of queries; only points within its rounding error of the
    kth are measured from their differences.
    """
    x, ids = np.stack(points[vec].to_numpy()), points["_id"].to_numpy()
    q, own = np.stack(queries[vec].to_numpy()), queries["_id"].to_numpy()
    whole = np.isfinite(x).all(axis=1)  # the others are at no finite distance from anything
    x, ids = x[whole], ids[whole]
    if not len(x):
        return pd.DataFrame({"_id": own[:0], "_nbr": ids, "_dist": np.zeros(0)})
    with np.errstate(all="ignore"):
        return _nearest(q, own, x, ids, k)


def _nearest(q: np.ndarray, own: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> pd.DataFrame:
    middle = x.mean(axis=0)
    low, norms = x - middle, ((x - middle) ** 2).sum(axis=1)
    out_q, out_n, out_d = [], [], []
    step = max(1, PRODUCT_CELLS // len(x))
    for at in range(0, len(q), step):
        part = q[at : at + step] - middle
        size = (part**2).sum(axis=1)
        rough = size[:, None] + norms[None, :] - 2.0 * (part @ low.T)
        slack = 1e-12 * (len(middle) + 8) * (size + norms.max())
        rough[own[at : at + step, None] == ids[None, :]] = np.inf
        most = min(k, len(x))
        limit = np.partition(rough, most - 1, axis=1)[:, most - 1] + 2 * slack
        for j in range(len(part)):
            near = np.flatnonzero(~(rough[j] > limit[j]) & (ids != own[at + j]))  # what overflowed is measured too
            d = np.sqrt(((x[near] - q[at + j]) ** 2).sum(axis=1))
            best = np.lexsort((ids[near], d))[:k]
            best = best[np.isfinite(d[best])]
            out_q.append(np.full(len(best), own[at + j]))
            out_n.append(ids[near[best]])
            out_d.append(d[best])
    return pd.DataFrame({"_id": np.concatenate(out_q), "_nbr": np.concatenate(out_n), "_dist": np.concatenate(out_d)})


def nearest_neighbours(
    points: DataFrame, by: list[str], vec: str, row_id: str, k: int = 5, queries: DataFrame | None = None, block_rows: int = 4096
) -> DataFrame:
    """(by, id, rank, nbr, dist): exact k nearest neighbours inside each group.

    Points are ordered by their distance to the group mean and cut into blocks; points at
    equal distance (copies) are spread over several blocks by hash. A query first looks
    into its own block; the k-th distance found there bounds, by the triangle inequality,
    which other blocks can hold a strictly nearer point, and only those are visited. Copies
    find k neighbours at distance 0 at once and go no further; where copies fill more than a block,
    the smallest ids of all of them are known to each.

    Queries that look further are packed, in the order of the blocks, into blocks of their own of about ``block_rows``, however
    few of the points ask; a block of points is sent once to each block of queries that visits it, so what is
    shuffled is points x query blocks + queries x point blocks at worst. No task holds more than one block of each.
    """
    pts = points.select(*by, F.col(row_id).cast("long").alias("_id"), F.transform(vec, lambda v: v.cast("double")).alias("_v"))
    dims = pts.select(*by, F.posexplode("_v").alias("_i", "_x")).groupBy(*by, "_i").agg(F.avg("_x").alias("_m"))
    center = dims.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_m"))), lambda s: s["_m"]).alias("_c"))
    gap = F.zip_with("_v", "_c", lambda a, b: (a - b) * (a - b))
    pts = pts.join(measured(center), by).withColumn("_t", F.sqrt(F.aggregate(gap, F.lit(0.0), lambda s, v: s + v))).drop("_c")
    order = running_by_value(pts.select(*by, "_t"), by, "_t")
    placed = pts.join(order.select(*by, "_t", "before", "n"), [*by, "_t"])
    spread = F.pmod(F.xxhash64("_id"), F.ceil(F.col("n") / F.lit(block_rows)))
    block = F.floor(F.col("before") / F.lit(block_rows)) + spread
    pts = cut_lineage(placed.withColumn("_block", block.cast("long")).withColumn("_many", F.col("n") > block_rows).drop("before", "n"))
    asked = pts
    if queries is not None:
        asked = pts.join(queries.select(*by, F.col(row_id).cast("long").alias("_id")), [*by, "_id"], "left_semi")
    schema = T.StructType([pts.schema[c] for c in by]).add("_id", "long").add("_nbr", "long").add("_dist", "double")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return no_rows(schema)
        found = _top_k(left, right, k, "_v")
        for c in by:
            found[c] = left[c].iloc[0]
        return found[[f.name for f in schema.fields]]

    own = [*by, "_block"]
    sides = [x.select(*own, "_id", "_v").groupBy(*own) for x in (asked, renamed(pts))]
    first = cut_lineage(sides[0].cogroup(sides[1]).applyInPandas(search, schema))
    reach = first.groupBy(*by, "_id").agg(F.count(F.lit(1)).alias("_k"), F.max("_dist").alias("_far"))
    far = asked.join(reach, [*by, "_id"], "left").where(F.col("_k").isNull() | (F.col("_k") < k) | (F.col("_far") > 0))
    # An own block with fewer than k points bounds nothing: look everywhere.
    radius = F.when(F.col("_k") >= k, F.col("_far") * (1 + 1e-9)).otherwise(F.lit(1e300))
    far = far.withColumns({"_lo": F.col("_t") - radius, "_hi": F.col("_t") + radius})
    blocks = measured(pts.groupBy(*by).agg(F.max("_block").alias("_last")))
    if blocks.agg(F.max("_last")).first()[0]:
        edge = lambda c: far.select(*by, F.col(c).alias("_t"), F.lit(0).alias("_p"))
        merged = pts.select(*by, "_t", F.lit(1).alias("_p")).unionByName(edge("_lo")).unionByName(edge("_hi"))
        ranks = running_by_value(merged, by, "_t", {"_np": "_p"})
        low = F.floor(F.greatest(F.col("before__np") - 1, F.lit(0)) / F.lit(block_rows)).cast("long")
        high = F.floor((F.col("before__np") + F.col("_np")) / F.lit(block_rows)).cast("long")
        ranks = ranks.select(*by, "_t", low.alias("_b0"), high.alias("_b1"))
        far = far.join(ranks.select(*by, F.col("_t").alias("_lo"), "_b0"), [*by, "_lo"])
        far = far.join(ranks.select(*by, F.col("_t").alias("_hi"), "_b1"), [*by, "_hi"]).join(blocks, by)
        # Values that tie across a block edge may sit one block lower.
        far = far.withColumns({"_b0": F.greatest(F.col("_b0") - 1, F.lit(0)), "_b1": F.least(F.col("_b1"), F.col("_last"))})
        # Queries of neighbouring blocks stand together: their number in the blocks before, then a hash inside the block.
        counts = far.groupBy(*own).agg(F.count(F.lit(1)).alias("_q"))
        upto = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        counts = measured(counts.withColumn("_before", F.coalesce(F.sum("_q").over(upto), F.lit(0))))
        place = F.col("_before") + F.pmod(F.xxhash64("_id"), F.col("_q"))
        far = far.join(counts, own).withColumn("_qblock", F.floor(place / F.lit(block_rows)).cast("long"))
        far = cut_lineage(far.select(*by, "_id", "_v", "_qblock", F.col("_block").alias("_own"), "_b0", "_b1"))
        pair = [*by, "_block", "_qblock"]
        probe = far.withColumn("_block", F.explode(F.sequence("_b0", "_b1"))).where(F.col("_block") != F.col("_own")).select(*pair, "_id", "_v")
        visits = measured(far.select(*by, "_qblock", "_own", "_b0", "_b1").distinct().withColumn("_block", F.explode(F.sequence("_b0", "_b1"))).where(F.col("_block") != F.col("_own")).select(*pair).distinct())
        target = pts.select(*by, "_id", "_v", "_block").join(visits, own)
        rest = probe.groupBy(*pair).cogroup(renamed(target).groupBy(*pair)).applyInPandas(search, schema)
        first = first.unionByName(rest)
    # Copies that fill several blocks tie at distance 0: the smallest ids of all their blocks are candidates of each.
    least = lambda c: F.slice(F.array_sort(c), 1, k + 1)
    odd = F.exists("_v", lambda x: F.isnan(x) | (F.abs(x) == float("inf")))
    copies = pts.where(F.col("_many") & ~odd).groupBy(*by, "_v", "_block").agg(least(F.collect_list(F.struct("_id", "_block"))).alias("_ids"))
    copies = copies.groupBy(*by, "_v").agg(least(F.flatten(F.collect_list("_ids"))).alias("_ids"))
    twins = asked.where("_many").join(measured(copies), [*by, "_v"]).select(*by, "_id", "_block", F.explode("_ids").alias("_mate"))
    twins = twins.where("_mate._block <> _block").select(*by, "_id", F.col("_mate._id").alias("_nbr"), F.lit(0.0).alias("_dist"))
    # A query that looked further has met some of them.
    first = first.unionByName(twins).distinct()
    # Each block gave at most k candidates; the ranking is cut to k before it is shuffled.
    closest = Window.partitionBy(*by, "_id").orderBy("_dist", "_nbr")
    found = first.withColumn("rank", F.row_number().over(closest)).where(F.col("rank") <= k)
    return found.select(*by, F.col("_id").alias(row_id), "rank", F.col("_nbr").alias("nbr"), F.col("_dist").alias("dist"))


def draw(*parts: str | int) -> Column:
    """A number below 2**48 from columns (by name) and integers: the first twelve hex digits of their MD5, joined by bars."""
    text = F.concat_ws("|", *[F.col(x).cast("string") if isinstance(x, str) else F.lit(str(x)) for x in parts])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def smote(
    df: DataFrame,
    vec: str,
    label: str,
    by: list[str],
    row_id: str,
    exclude: tuple[str, ...] = ("WAIT",),
    k: int = 5,
    seed: int = 42,
    block_rows: int = 4096,
) -> DataFrame:
    """Raise every class not excluded to the size of the largest of them, per ``by`` group.

    New rows lie between a base row and one of its k nearest neighbours of the class. Base,
    neighbour and position come from :func:`draw`, so the result does not depend on partitioning.
    Groups with fewer than two such classes stay as they are.
    """
    rows = df.select(*by, label, F.col(row_id).cast("long").alias(row_id), F.transform(vec, lambda v: v.cast("double")).alias(vec))
    minor = rows.where(~F.col(label).isin(*exclude))
    counts = minor.groupBy(*by, label).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.groupBy(*by).agg(F.max("_n").alias("_top"), F.count(F.lit(1)).alias("_classes"))
    need = counts.join(top, by).where("_classes >= 2 AND _n < _top AND _n >= 2")
    need = measured(need.select(*by, label, "_n", (F.col("_top") - F.col("_n")).alias("_need")))
    base = minor.join(need, [*by, label])
    hashed = base.select(*by, label, row_id, draw(row_id, seed).cast("double").alias("_h"), "_n", "_need")
    order = running_by_value(hashed, [*by, label], "_h").select(*by, label, "_h", "before")
    same_hash = Window.partitionBy(*by, label, "_h").orderBy(row_id)
    place = F.col("before") + F.row_number().over(same_hash) - 1
    copies = hashed.join(order, [*by, label, "_h"]).withColumn("_place", place)
    extra = (F.col("_place") < F.pmod(F.col("_need"), F.col("_n"))).cast("long")
    copies = copies.withColumn("_c", F.floor(F.col("_need") / F.col("_n")) + extra)
    copies = cut_lineage(copies.where("_c > 0").select(*by, label, row_id, "_c"))
    near = nearest_neighbours(minor, [*by, label], vec, row_id, k, copies, block_rows)
    lists = near.groupBy(*by, label, row_id).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "nbr"))), lambda s: s["nbr"]).alias("_nbrs")
    )
    new = copies.join(lists, [*by, label, row_id]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_c").cast("int"))))
    chosen = (draw(row_id, "copy", seed + 1) % F.size("_nbrs")).cast("int")
    new = new.withColumn("_nbr", F.get("_nbrs", chosen)).select(*by, label, row_id, "copy", "_nbr")
    new = new.join(minor, [*by, label, row_id])
    mate = minor.select(*by, label, F.col(row_id).alias("_nbr"), F.col(vec).alias("_w"))
    new = new.join(mate, [*by, label, "_nbr"])
    u = draw(row_id, "copy", seed + 2) % 1_000_003 / F.lit(1_000_003.0)
    new = new.withColumn("_u", u).withColumn(vec, F.zip_with(vec, "_w", lambda a, b: a + F.col("_u") * (b - a)))
    cols = [*by, label, row_id, "copy", vec]
    return rows.withColumn("copy", F.lit(0)).select(cols).unionByName(new.select(cols))
