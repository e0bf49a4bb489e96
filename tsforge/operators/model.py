"""Per-fold training and scoring of windows: all folds in the same passes over the data."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsforge.functions.scalars import softmax, time_decay
from tsforge.functions.timeunits import micros
from tsforge.operators.folds import assign_folds
from tsforge.session import cut_lineage, measured


def class_weights(df: DataFrame, y: str = "y", by: list[str] | None = None) -> DataFrame:
    """(by, y, class_weight): N / n_class scaled to mean 1 over the classes present."""
    by = by or []
    counts = df.groupBy(*by, y).agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*(by or [F.lit(1)]))  # one row per class
    inverse = 1.0 / F.col("_n")
    return counts.select(*by, y, (inverse / F.avg(inverse).over(group)).alias("class_weight"))


def feature_scale(train: DataFrame, vec: str, n_features: int, by: list[str]) -> DataFrame:
    """(by, mean, std): per-feature statistics over all steps of the TRAIN windows; a zero std counts as 1."""
    cells = train.select(*by, F.posexplode(vec).alias("_i", "_x"))
    stats = cells.groupBy(*by, F.pmod("_i", F.lit(n_features)).alias("_f")).agg(
        F.avg(F.col("_x").cast("double")).alias("m"), F.stddev_pop(F.col("_x").cast("double")).alias("s")
    )
    ordered = F.array_sort(F.collect_list(F.struct("_f", "m", "s")))  # one entry per feature
    stats = stats.groupBy(*by).agg(ordered.alias("_s"))
    return stats.select(
        *by,
        F.transform("_s", lambda x: x["m"]).alias("mean"),
        F.transform("_s", lambda x: F.when(x["s"] > 0, x["s"]).otherwise(1.0)).alias("std"),
    )


def standardise_windows(df: DataFrame, scale: DataFrame, vec: str, n_features: int, by: list[str]) -> DataFrame:
    """Windows with every feature centred and scaled by the statistics of its fold."""
    d = df.join(measured(scale), by)
    at = lambda c, i: F.get(c, F.pmod(i, F.lit(n_features)).cast("int"))
    z = F.transform(vec, lambda x, i: (x.cast("double") - at("mean", i)) / at("std", i))
    return d.withColumn(vec, z).drop("mean", "std")


def training_rows(windows: DataFrame, folds: DataFrame, n_features: int, vec: str = "window", ts: str = "ts", lam: float = 0.98) -> tuple[DataFrame, DataFrame]:
    """All fold rows, standardised with TRAIN statistics and weighted by class and age; and the statistics."""
    rows = assign_folds(windows, folds, ts)
    train = rows.where("split = 'train'")
    scale = measured(feature_scale(train, vec, n_features, ["fold_id"]))
    newest = measured(train.groupBy("fold_id").agg(F.max(micros(ts)).alias("_newest")))
    weights = measured(class_weights(train, "y", ["fold_id"]))
    d = standardise_windows(rows, scale, vec, n_features, ["fold_id"])
    d = d.join(newest, "fold_id").join(weights, ["fold_id", "y"], "left")
    decay = F.least(time_decay(micros(ts), F.col("_newest"), lam), F.lit(1.0))
    d = d.withColumn("weight", F.coalesce("class_weight", F.lit(1.0)) * decay)
    return d.drop("_newest", "class_weight"), scale


CLASSES = 3
PARTS = 16
FIT_SCHEMA = "fold_id int, part int, size long, value array<double>"


def _gradients(data: DataFrame, models: dict[int, np.ndarray], size: int) -> dict[int, np.ndarray]:
    """For each fold the weight, the loss, the squared lengths and the gradient of its own coefficients, all summed in one pass."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            folds, y, weight = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fold_id", "y", "weight"))
            x = np.column_stack([batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(len(y), size - 1), np.ones(len(y))])
            for fold in np.unique(folds).tolist():
                own = folds == fold
                z = x[own] @ models[fold].T
                z -= z.max(axis=1, keepdims=True)
                total = np.exp(z).sum(axis=1, keepdims=True)
                wanted, w = y[own].astype(int), weight[own].astype(float)
                error = np.exp(z) / total
                loss = w @ (np.log(total[:, 0]) - z[np.arange(len(w)), wanted])
                error[np.arange(len(w)), wanted] -= 1
                found = np.r_[w.sum(), loss, w @ np.square(x[own]).sum(axis=1), ((error * w[:, None]).T @ x[own]).ravel()]
                sums[fold] = sums[fold] + found if fold in sums else found
        for fold, value in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([fold], pa.int32()), pa.array([TaskContext.get().partitionId() % PARTS], pa.int32()), pa.array([1]), pa.array([value.tolist()])], ["fold_id", "part", "size", "value"])

    def added(table: pa.Table) -> pa.Table:
        total = np.sum([np.asarray(v) for v in table.column("value").to_pylist()], axis=0)
        return pa.table({"fold_id": table.column("fold_id").slice(0, 1), "part": table.column("part").slice(0, 1), "size": [table.num_rows], "value": [total.tolist()]}, schema=pa.schema([("fold_id", pa.int32()), ("part", pa.int32()), ("size", pa.int64()), ("value", pa.list_(pa.float64()))]))

    sums = data.mapInArrow(partial, FIT_SCHEMA).groupBy("fold_id", "part").applyInArrow(added, FIT_SCHEMA)
    out: dict[int, np.ndarray] = {}
    for r in sums.collect():  # at most PARTS rows a fold
        out[r["fold_id"]] = out.get(r["fold_id"], 0) + np.array(r["value"])
    return out


def fit_folds(rows: DataFrame, vec: str = "window", reg: float = 0.01, tol: float = 1e-5, passes: int = 200) -> DataFrame:
    """(fold_id, coef, loss, gradient, n_train): one weighted multinomial classifier per fold, all fitted together.

    Minimises the weighted mean log loss of the TRAIN rows plus reg/2 times the squared coefficients
    (intercepts, the last of each row of ``coef``, are free and sum to zero). Every pass over the data gives loss
    and gradient of all folds; limited-memory quasi-Newton steps are taken per fold between the passes. A fold
    is done when no entry of its gradient exceeds ``tol``, and keeps its coefficients from then on.
    """
    data = cut_lineage(rows.where("split = 'train'").select(F.col("fold_id").cast("int"), F.col("y").cast("int"), F.col("weight").cast("double"), F.col(vec).cast("array<double>").alias("_x")))
    counts = {r["fold_id"]: (r["n"], r["p"]) for r in data.groupBy("fold_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("_x")).alias("p")).collect()}  # one row a fold
    if not counts:
        raise ValueError("no fold has train rows")
    size = max(p for _, p in counts.values()) + 1
    free = np.ones((CLASSES, size))
    free[:, -1] = 0
    now = {f: np.zeros((CLASSES, size)) for f in counts}
    state = {f: {"pairs": [], "best": None, "step": 1.0, "way": None, "done": False} for f in counts}
    for _ in range(passes):
        sums = _gradients(data.where(F.col("fold_id").isin(*[f for f in counts if not state[f]["done"]])), now, size)
        for f, value in sums.items():
            s, at = state[f], now[f]
            loss = value[1] / value[0] + reg / 2 * float((free * at * at).sum())
            slope = (value[3:].reshape(CLASSES, size) / value[0] + reg * free * at).ravel()
            if s["best"] is not None and loss > s["best"][1] + 1e-4 * s["step"] * float(s["best"][2] @ s["way"]) and s["step"] > 1e-10:
                s["step"] /= 2  # too far: half the way from the last good point
                now[f] = s["best"][0] + s["step"] * s["way"].reshape(CLASSES, size)
                continue
            if s["best"] is not None:
                moved, turned = (at - s["best"][0]).ravel(), slope - s["best"][2]
                if moved @ turned > 1e-14:
                    s["pairs"] = [*s["pairs"], (moved, turned)][-10:]
            s["best"], s["step"] = (at, loss, slope), 1.0
            if np.abs(slope).max() <= tol:
                s["done"] = True
                continue
            s["way"] = -_preconditioned(slope, s["pairs"]) if s["pairs"] else -slope / (value[2] / value[0] / 2 + reg)
            now[f] = at + s["way"].reshape(CLASSES, size)
        if all(s["done"] for s in state.values()):
            break
    out = []
    for f, s in sorted(state.items()):
        at, loss, slope = s["best"]
        at = at - np.outer(np.ones(CLASSES), (1 - free[0]) * at.mean(axis=0))
        out.append((f, at.tolist(), float(loss), float(np.abs(slope).max()), counts[f][0]))
    return rows.sparkSession.createDataFrame(out, "fold_id int, coef array<array<double>>, loss double, gradient double, n_train long")


def _preconditioned(slope: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The slope times the inverse curvature that the last moves have shown."""
    out, kept = slope.copy(), []
    for moved, turned in reversed(pairs):
        share = (moved @ out) / (moved @ turned)
        kept.append(share)
        out -= share * turned
    if pairs:
        moved, turned = pairs[-1]
        out *= (moved @ turned) / (turned @ turned)
    for (moved, turned), share in zip(pairs, reversed(kept)):
        out += moved * (share - (turned @ out) / (moved @ turned))
    return out


def score_folds(models: DataFrame, rows: DataFrame, keys: list[str], vec: str = "window", splits: tuple[str, ...] = ("val", "oos")) -> DataFrame:
    """(keys, y, fold_id, split, p_wait, p_long, p_short, logits_0..2) of the held-out rows of every fold, in one pass."""
    coef = measured(models.select("fold_id", "coef"))
    d = rows.where(F.col("split").isin(*splits)).join(coef, "fold_id")
    logits = F.transform(
        "coef", lambda c: F.aggregate(F.zip_with(vec, c, lambda x, b: F.when(x.isNotNull(), x * b).otherwise(b)), F.lit(0.0), lambda a, v: a + v)
    )
    d = d.withColumn("_z", logits).withColumn("_p", softmax("_z"))
    names = ("p_wait", "p_long", "p_short")
    return d.select(*keys, "y", "fold_id", "split", *[F.get("_p", F.lit(i)).alias(n) for i, n in enumerate(names)], *[F.get("_z", F.lit(i)).alias(f"logits_{i}") for i in range(CLASSES)])


def augmented_rows(augmented: DataFrame, scale: DataFrame, n_features: int, vec: str = "window") -> DataFrame:
    """Over-sampled TRAIN windows (fold_id, window, y) made ready for :func:`fit_folds`; no age weight."""
    weights = measured(class_weights(augmented, "y", ["fold_id"]))
    d = standardise_windows(augmented, scale, vec, n_features, ["fold_id"]).join(weights, ["fold_id", "y"])
    return d.withColumns({"split": F.lit("train"), "weight": F.col("class_weight")}).drop("class_weight")
