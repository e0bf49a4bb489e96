"""Probability calibration, fold ensembling and threshold tuning.

Input tables hold ``fold_id, split, y`` and either ``logits_0..2``, ``p_0..2`` or
``p_wait, p_long, p_short``. Fold tables (temperatures, weights) have one row per fold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsforge.functions.scalars import argmax3, logit_from_prob, softmax3, threshold_grid
from tsforge.operators.quality import gate, one_row
from tsforge.operators.ranks import running_by_value
from tsforge.session import measured

# Temperature grids as (first, step, points).
GRID = (0.5, 0.05, 91)
WIDE_GRID = (5.0, 0.05, 101)
BINS = 15


def with_logits(df: DataFrame) -> DataFrame:
    """Add z0, z1, z2 from whichever score columns the table has."""
    if "logits_0" in df.columns:
        z = [F.col(f"logits_{i}") for i in range(3)]
    elif "p_0" in df.columns:
        z = [logit_from_prob(f"p_{i}") for i in range(3)]
    elif {"p_wait", "p_long", "p_short"} <= set(df.columns):
        z = [logit_from_prob(c) for c in ("p_wait", "p_long", "p_short")]
    else:
        raise ValueError("no logits or probabilities among the columns")
    return df.withColumns({f"z{i}": c.cast("double") for i, c in enumerate(z)})


def row_nll(p0: Column, p1: Column, p2: Column, y: Column) -> Column:
    return -F.log(F.when(y == 0, p0).when(y == 1, p1).otherwise(p2) + 1e-9)


def _z() -> tuple[Column, Column, Column]:
    return F.col("z0"), F.col("z1"), F.col("z2")


def _grid_nll(rows: DataFrame, grid: tuple[float, float, int], by: list[str]) -> DataFrame:
    """Mean NLL per (by, grid point); rows are expanded and summed inside the scan stage."""
    first, step, n = grid
    points = F.expr(f"transform(sequence(0, {n - 1}), i -> named_struct('i', i, 't', {first}D + {step}D * i))")
    d = rows.withColumn("_g", F.explode(points))
    p = softmax3(*_z(), F.col("_g.t"))
    return d.groupBy(*by, F.col("_g.i").alias("i"), F.col("_g.t").alias("t")).agg(F.avg(row_nll(*p, F.col("y"))).alias("nll"))


def nll(df: DataFrame, by: list[str], temperature: Column | float = 1.0) -> DataFrame:
    p = softmax3(*_z(), temperature)
    return with_logits(df).groupBy(*by).agg(F.avg(row_nll(*p, F.col("y"))).alias("nll"))


def ece(df: DataFrame, by: list[str], p: tuple[str, str, str] = ("p_0", "p_1", "p_2"), bins: int = BINS) -> DataFrame:
    """Expected calibration error of the top class over equal bins (lo, hi]."""
    cols = [F.col(c) for c in p]
    conf = F.greatest(*cols)
    d = df.withColumns({"_conf": conf, "_hit": (argmax3(*cols) == F.col("y")).cast("double"), "_bin": F.ceil(conf * bins)})
    b = d.groupBy(*by, "_bin").agg(F.sum("_hit").alias("h"), F.sum("_conf").alias("c"), F.count(F.lit(1)).alias("n"))
    inside = (F.col("_bin") >= 1) & (F.col("_bin") <= bins)
    return b.groupBy(*by).agg((F.sum(F.when(inside, F.abs(F.col("h") - F.col("c"))).otherwise(0.0)) / F.sum("n")).alias("ece"))


def fit_temperature(probs: DataFrame, by: str = "fold_id") -> DataFrame:
    """(fold, temperature, nll_val, ece_val, ece_oos): the grid temperature of least validation NLL.

    When the optimum is the upper end of the grid, a second grid up to 10 is tried.
    """
    rows = with_logits(probs).select(by, "split", "y", "z0", "z1", "z2")
    val = rows.where("split = 'val'")
    first = F.min_by(F.struct("i", "t"), F.struct("nll", "i"))
    best = measured(_grid_nll(val, GRID, [by]).groupBy(by).agg(first.alias("b"), F.min("nll").alias("nll")))
    edge = best.where(F.col("b.i") == GRID[2] - 1).select(by)
    fit = best.select(by, F.col("b.t").alias("temperature"), F.col("nll").alias("nll_val"))
    if edge.count():
        wide = _grid_nll(val.join(edge, by), WIDE_GRID, [by])
        wide = wide.groupBy(by).agg(first.alias("b"), F.min("nll").alias("nll2")).select(by, F.col("b.t").alias("t2"), "nll2")
        better = F.col("nll2") < F.col("nll_val")
        fit = fit.join(wide, by, "left").select(
            by,
            F.when(better, F.col("t2")).otherwise(F.col("temperature")).alias("temperature"),
            F.when(better, F.col("nll2")).otherwise(F.col("nll_val")).alias("nll_val"),
        )
    fit = measured(fit)
    p = softmax3(*_z(), F.col("temperature"))
    scored = rows.join(fit, by).withColumns({f"p_{i}": c for i, c in enumerate(p)})
    errors = ece(scored, [by, "split"]).groupBy(by).pivot("split", ["val", "oos"]).agg(F.max("ece"))
    return fit.join(errors, by).select(by, "temperature", "nll_val", F.col("val").alias("ece_val"), F.col("oos").alias("ece_oos"))


def calibrated(probs: DataFrame, calib: DataFrame, by: str = "fold_id") -> DataFrame:
    """p_0, p_1, p_2 after the temperature of the fold (1 when the fold is unknown)."""
    temps = measured(calib.select(by, F.col("temperature").alias("_t")))
    d = with_logits(probs).drop("p_0", "p_1", "p_2").join(temps, by, "left")
    p = softmax3(*_z(), F.coalesce("_t", F.lit(1.0)))
    return d.withColumns({f"p_{i}": c for i, c in enumerate(p)}).drop("_t", "z0", "z1", "z2")


def _trade_columns(df: DataFrame) -> DataFrame:
    p = [F.col(f"p_{i}") for i in range(3)]
    d = df.withColumns({"_pred": argmax3(*p), "_conf": F.greatest(*p)})
    right = F.when(F.col("_pred") == F.col("y"), 1.0).otherwise(-1.0)
    return d.withColumn("_pnl", F.when(F.col("_pred") == 0, 0.0).otherwise(right))


def ev_trade(df: DataFrame, taus: list[float], cost_bps: float = 5.0, by: list[str] | None = None) -> DataFrame:
    """(by, tau, n_take, ev_per_take, ev_per_trade, precision, recall) for every threshold.

    ``ev_per_take`` counts confident WAIT predictions as trades with no gain;
    ``ev_per_trade`` leaves them out.
    """
    by = by or []
    d = _trade_columns(df)
    d = d.groupBy(*by, "y", "_pred", "_pnl", F.size(F.filter(F.array(*[F.lit(t) for t in taus]), lambda t: t <= F.col("_conf"))).alias("_k"))
    # Row confidence only matters through how many thresholds it reaches.
    d = d.agg(F.count(F.lit(1)).alias("_n"))
    grid = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(t).alias("tau")) for i, t in enumerate(taus)])
    d = d.withColumn("_g", F.explode(grid)).withColumn("_take", F.col("_k") > F.col("_g.i"))
    cost = cost_bps / 1e4

    def total(cond: Column, value: Column | None = None) -> Column:
        v = F.col("_n") if value is None else F.col("_n") * value
        return F.coalesce(F.sum(F.when(cond, v)), F.lit(0)).cast("double")

    take, pred, y = F.col("_take"), F.col("_pred"), F.col("y")
    agg = d.groupBy(*by, F.col("_g.i").alias("i"), F.col("_g.tau").alias("tau")).agg(
        total(take).alias("n_take"),
        total(take & (pred != 0)).alias("_n_trade"),
        total(take, F.col("_pnl")).alias("_pnl"),
        total((pred == y) & take & (y != 0)).alias("_tp"),
        total((pred != y) & take & (pred != 0)).alias("_fp"),
        total((pred != 0) & ~take & (y != 0)).alias("_fn"),
    )

    def ratio(a: Column, b: Column, minus: float = 0.0) -> Column:
        return F.when(b > 0, F.try_divide(a, b) - minus).otherwise(0.0)

    return agg.select(
        *by,
        "i",
        "tau",
        F.col("n_take").cast("long").alias("n_take"),
        ratio(F.col("_pnl"), F.col("n_take"), cost).alias("ev_per_take"),
        ratio(F.col("_pnl"), F.col("_n_trade"), cost).alias("ev_per_trade"),
        ratio(F.col("_tp"), F.col("_tp") + F.col("_fp")).alias("precision"),
        ratio(F.col("_tp"), F.col("_tp") + F.col("_fn")).alias("recall"),
    )


def ensemble_weights(probs: DataFrame, calib: DataFrame, cost_bps: float = 5.0, by: str = "fold_id") -> DataFrame:
    """(fold, ev, weight, temperature, ensemble_temperature) from out-of-sample EV at tau 0.5.

    Weights are positive EVs over their sum, or uniform when no fold is positive.
    """
    oos = calibrated(probs.where("split = 'oos'"), calib, by)
    ev = ev_trade(oos, [0.5], cost_bps, [by]).select(by, F.col("ev_per_take").alias("ev"))
    temps = calib.select(by, "temperature")
    d = ev.join(temps, by, "left").withColumn("temperature", F.coalesce("temperature", F.lit(1.0)))
    all_folds = Window.partitionBy(F.lit(1))  # one row per fold
    gain = F.greatest("ev", F.lit(0.0))
    d = d.withColumn("_g", gain).withColumns({"_s": F.sum("_g").over(all_folds), "_n": F.count(F.lit(1)).over(all_folds)})
    d = d.withColumn("weight", F.when(F.col("_s") > 0, F.try_divide("_g", "_s")).otherwise(1.0 / F.col("_n")))
    d = d.withColumn("ensemble_temperature", F.sum(F.col("weight") * F.col("temperature")).over(all_folds))
    return d.select(by, "ev", "weight", "temperature", "ensemble_temperature")


def tune_tau(probs: DataFrame, calib: DataFrame, grid: str = "0.50:0.80:0.025", cost_bps: float = 5.0, by: str = "fold_id") -> DataFrame:
    """(tau, ev_per_take, ev_per_trade, precision, recall, best) over the threshold grid; the first maximum is best."""
    taus = threshold_grid(*[float(x) for x in grid.split(":")])
    oos = calibrated(probs.where("split = 'oos'"), calib, by)
    curve = ev_trade(oos, taus, cost_bps)
    whole = Window.partitionBy(F.lit(1)).orderBy(F.desc("ev_per_take"), "i")  # one row per threshold
    return curve.withColumn("best", F.row_number().over(whole) == 1).drop("i")


def tau_summary(probs: DataFrame, calib: DataFrame, order: str, grid: str = "0.50:0.80:0.025", cost_bps: float = 5.0, by: str = "fold_id") -> DataFrame:
    """One row: best tau, its EV, overall ECE, EV of the two halves (by fold, then ``order``) and a normal 95 % interval."""
    curve = measured(tune_tau(probs, calib, grid, cost_bps, by))
    best = curve.where("best").select(F.col("tau").alias("best_tau"), F.col("ev_per_take").alias("ev_trade"))
    tau = best.first()["best_tau"]
    oos = calibrated(probs.where("split = 'oos'"), calib, by)
    ranked = running_by_value(oos.select(by, order), [by], order).select(by, order, "before", "n")
    sizes = ranked.groupBy(by).agg(F.sum("n").alias("_size"))
    upto = Window.partitionBy(F.lit(1)).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)  # one row per fold
    sizes = sizes.withColumn("_off", F.coalesce(F.sum("_size").over(upto), F.lit(0.0)))
    sizes = measured(sizes.withColumn("_total", F.sum("_size").over(Window.partitionBy(F.lit(1)))))
    place = ranked.join(sizes, by).select(by, order, (F.col("before") + F.col("_off") < F.floor(F.col("_total") / 2)).alias("_first"))
    halves = ev_trade(oos.join(place, [by, order]), [tau], cost_bps, ["_first"]).select("_first", F.col("ev_per_take").alias("ev"))
    seg = halves.agg(
        F.max(F.when(F.col("_first"), F.col("ev"))).alias("ev_first_half"),
        F.max(F.when(~F.col("_first"), F.col("ev"))).alias("ev_second_half"),
        F.avg("ev").alias("_mu"),
        F.coalesce(F.stddev_samp("ev"), F.lit(0.0)).alias("_sd"),
    )
    seg = seg.withColumns({"ci_low": F.col("_mu") - 1.96 * F.col("_sd"), "ci_high": F.col("_mu") + 1.96 * F.col("_sd")})
    return one_row(best, ece(oos, []), seg.drop("_mu", "_sd"))


def merge_calibrated(
    probs: DataFrame, calib: DataFrame, weights: DataFrame, split: str, keys: list[str], by: str = "fold_id"
) -> DataFrame:
    """(keys, p_0, p_1, p_2): calibrated fold probabilities, weighted, summed and renormalised."""
    w = measured(weights.select(by, F.col("weight").alias("_w")))
    d = calibrated(probs.where(F.col("split") == split), calib, by).join(w, by, "left")
    d = d.groupBy(*keys).agg(*[F.sum(F.col(f"p_{i}") * F.coalesce("_w", F.lit(1.0))).alias(f"s{i}") for i in range(3)])
    total = F.col("s0") + F.col("s1") + F.col("s2") + 1e-12
    return d.select(*keys, *[(F.col(f"s{i}") / total).alias(f"p_{i}") for i in range(3)])


def class_metrics(df: DataFrame, by: list[str]) -> DataFrame:
    """(by, class, precision, recall, support) of the top class of p_0, p_1, p_2."""
    p = [F.col(f"p_{i}") for i in range(3)]
    cells = df.groupBy(*by, argmax3(*p).alias("_pred"), F.col("y").alias("_y")).agg(F.count(F.lit(1)).alias("_n"))
    d = cells.withColumn("class", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    hit = F.sum(F.when((F.col("_pred") == F.col("class")) & (F.col("_y") == F.col("class")), F.col("_n")).otherwise(0))
    said = F.sum(F.when(F.col("_pred") == F.col("class"), F.col("_n")).otherwise(0))
    was = F.sum(F.when(F.col("_y") == F.col("class"), F.col("_n")).otherwise(0))
    zero = F.lit(0.0)
    return d.groupBy(*by, "class").agg(
        F.coalesce(F.try_divide(hit, said), zero).alias("precision"),
        F.coalesce(F.try_divide(hit, was), zero).alias("recall"),
        was.alias("support"),
    )


def check_calibration(calib: DataFrame, weights: DataFrame, counts: DataFrame, by: str = "fold_id") -> DataFrame:
    """Gate: weights not negative and summing to 1, positive temperatures, validation and oos rows in every fold."""
    w = weights.agg(F.min("weight").alias("w_min"), F.sum("weight").alias("w_sum"))
    t = calib.agg(F.min("temperature").alias("t_min"))
    wide = counts.groupBy(by).pivot("split", ["val", "oos"]).agg(F.sum("n")).fillna(0)
    c = wide.agg(F.min("val").alias("val_min"), F.min("oos").alias("oos_min"))
    return gate(
        one_row(w, t, c),
        {
            "weight_not_negative": ("w_min", ">=", 0.0),
            "weight_sum_low": ("w_sum", ">=", 0.99),
            "weight_sum_high": ("w_sum", "<=", 1.01),
            "temperature_positive": ("t_min", ">", 0.0),
            "val_rows": ("val_min", ">", 0),
            "oos_rows": ("oos_min", ">", 0),
        },
    )


def check_thresholds(summary: DataFrame, ece_max: float = 0.10) -> DataFrame:
    """Gate on the tuning summary: calibration error and positive EV."""
    return gate(summary, {"ece": ("ece", "<=", ece_max), "ev_positive": ("ev_trade", ">", 0.0)})
