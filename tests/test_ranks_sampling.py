import numpy as np
import pandas as pd
import pytest
from helpers import AXIS, FIVE, pull, walk

from tsforge.functions.timeunits import DAY, MINUTE
from tsforge.operators import folds, ranks, sampling


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows, a third of them one and the same value, and a heavy tail."""
    rng = np.random.default_rng(3)
    v = np.r_[np.zeros(1000), rng.normal(0, 1, 1500), rng.lognormal(3, 3, 500)]
    pdf = pd.DataFrame({"g": "hot", "v": v})
    pdf = pd.concat([pdf, pd.DataFrame({"g": "cold", "v": rng.random(50)})], ignore_index=True)
    return pdf, spark.createDataFrame(pdf).repartition(7).persist()


@pytest.mark.parametrize("chunk", [10, 100_000])
def test_quantiles_and_ranks(skewed, chunk):
    pdf, d = skewed
    probs = [0.0, 0.01, 0.5, 0.77, 1.0]
    got = ranks.exact_quantiles(d, ["g"], "v", probs, chunk).toPandas()
    assert len(got) == 10
    for r in got.itertuples():
        assert r.quantile == pytest.approx(np.quantile(pdf.v[pdf.g == r.g], r.prob))
    got = ranks.pct_rank(d, ["g"], "v", "p", chunk).toPandas().sort_values(["g", "v"])
    want = pdf.assign(p=pdf.groupby("g").v.rank(method="average", pct=True)).sort_values(["g", "v"])
    np.testing.assert_allclose(got.p, want.p)
    run = ranks.running_by_value(d, ["g"], "v", chunk_values=chunk).toPandas()
    hot = run[run.g == "hot"].sort_values("v")
    assert hot.before.tolist() == (hot.n.cumsum() - hot.n).tolist() and hot.n.sum() == 3000


def test_outliers_and_heavy_ties_make_no_large_group(spark):
    """One outlier far off, and one value that half of all rows share."""
    rng = np.random.default_rng(9)
    v = np.r_[rng.normal(0, 1, 2000), np.full(2000, 0.5), [1e12]]
    d = spark.createDataFrame(pd.DataFrame({"g": "a", "v": v})).repartition(5)
    from pyspark.sql import functions as F

    sizes = ranks.value_chunks(d, ["g"], "v", {"n": F.lit(1)}, 100).groupBy("g", "_chunk").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 300 and sizes[1] >= 10
    sketch = ranks._sketch(d, ["g"], "v")
    places = spark.createDataFrame([("a", p) for p in (0, 700, 1500, 3000, 4000)], "g string, _pos long")
    small, large, inside = ranks.wanted_buckets(d, sketch, ["g"], "v", places, 20)
    assert small.groupBy("_bucket").agg(F.countDistinct("v").alias("n")).agg(F.max("n")).first()[0] <= 20
    v.sort()
    for chunk in (3, 20):
        got = ranks.values_at(d, ["g"], "v", [0, 1, 700, 1500, 3000, 3999, 4000], chunk).collect()
        assert {(r.pos, r.v) for r in got} == {(p, v[p]) for p in (0, 1, 700, 1500, 3000, 3999, 4000)} and len(got) == 7


@pytest.mark.parametrize("chunk", [10, 100_000])
def test_ks_detects_a_shift(spark, chunk):
    rng = np.random.default_rng(0)
    x, y = rng.normal(0, 1, 1000), rng.normal(0.5, 1, 1000)
    a, b = (spark.createDataFrame(pd.DataFrame({"x": s, "c": 1.0})) for s in (x, y))
    got = {r["feature"]: r for r in ranks.ks_two_sample(a, b, ["x", "c"], chunk).collect()}
    grid = np.r_[x, y]
    d = np.abs(np.searchsorted(np.sort(x), grid, "right") - np.searchsorted(np.sort(y), grid, "right")).max() / 1000
    assert got["x"]["d"] == pytest.approx(d) and got["x"]["p"] < 0.05
    assert got["c"]["d"] == 0 and got["c"]["p"] == 1


@pytest.mark.parametrize("block", [7, 4096])
def test_neighbours_equal_brute_force(spark, block):
    rng = np.random.default_rng(1)
    x = np.r_[rng.normal(0, 1, (90, 4)), np.zeros((30, 4))]  # many equal points
    pdf = pd.DataFrame({"id": range(120), "g": ["a"] * 80 + ["b"] * 40, "v": list(x)})
    got = sampling.nearest_neighbours(spark.createDataFrame(pdf), ["g"], "v", "id", 5, block_rows=block).toPandas()
    assert len(got) == 600
    for i, part in got.groupby("id"):
        same = pdf[(pdf.g == pdf.g[i]) & (pdf.id != i)]
        d = np.sqrt(((np.stack(same.v) - x[i]) ** 2).sum(axis=1))
        np.testing.assert_allclose(part.sort_values("rank").dist, np.sort(d)[:5], atol=1e-12)
        found = dict(zip(same.id, d))
        np.testing.assert_allclose(part.dist, [found[j] for j in part.nbr], atol=1e-12)
        assert part.nbr.nunique() == 5


def test_smote_balances_and_interpolates(spark):
    rng = np.random.default_rng(2)
    lab = ["WAIT"] * 80 + ["LONG"] * 20 + ["SHORT"] * 7
    pdf = pd.DataFrame({"fold_id": 0, "id": range(107), "y": lab, "x": list(rng.normal(0, 1, (107, 10)))})
    d = spark.createDataFrame(pdf)
    out = sampling.smote(d, "x", "y", ["fold_id"], "id").toPandas()
    assert out.y.value_counts().to_dict() == {"WAIT": 80, "LONG": 20, "SHORT": 20}
    short = np.stack(pdf.x[pdf.y == "SHORT"])
    for r in out[out["copy"] > 0].itertuples():
        base = pdf.x[r.id]
        # On a segment from the base to one of its five nearest neighbours.
        near = short[np.argsort(((short - base) ** 2).sum(axis=1))[1:6]]
        off = [np.linalg.norm((r.x - base) - np.dot(r.x - base, n - base) / np.dot(n - base, n - base) * (n - base)) for n in near]
        assert min(off) < 1e-9
    again = sampling.smote(d.repartition(5), "x", "y", ["fold_id"], "id").toPandas()
    key = ["id", "copy"]
    a, b = out.sort_values(key), again.sort_values(key)
    np.testing.assert_allclose(np.stack(a.x), np.stack(b.x))
    alone = d.where("y <> 'SHORT'")
    assert sampling.smote(alone, "x", "y", ["fold_id"], "id").count() == 100


def test_median_and_mad_helper():
    rng = np.random.default_rng(5)
    for n in (1, 2, 5, 6, 33):
        x = np.sort(rng.normal(0, 1, n).round(1))
        med, mad = sampling.median_and_mad(list(x))
        assert med == pytest.approx(np.median(x)) and mad == pytest.approx(np.median(np.abs(x - np.median(x))))


def test_robust_gate_in_chunks(spark):
    d = spark.createDataFrame(walk(300))
    args = (["close", "volume"], 0.9, 240 * MINUTE)
    a = pull(sampling.robust_gate(d, AXIS, *args))
    b = pull(sampling.robust_gate(d, AXIS.with_(bucket_us=10 * MINUTE, chunk_rows=40), *args))
    pd.testing.assert_frame_equal(a, b)
    assert 0.75 < a.keep.mean() < 0.97


def test_isolation_gate_flags_an_outlier(spark):
    pdf = walk(600, ("A",))
    pdf.loc[550, "volume"] = 1e5
    d = spark.createDataFrame(pdf)
    args = {"q": 0.95, "span_us": DAY, "refit_us": 360 * MINUTE, "trees": 30, "psi": 64}
    out = pull(sampling.isolation_gate(d, AXIS, ["volume"], **args))
    row = out[out.ts == pdf.ts[550]].iloc[0]
    assert row.keep == 0 and row.score > out.score.median() and out.keep.mean() > 0.6
    # The same forest whatever the number of parts the scored rows are cut into.
    parts = pull(sampling.isolation_gate(d, AXIS, ["volume"], part_rows=10, **args))
    np.testing.assert_allclose(parts.score, out.score)


def test_forest_scores_like_a_plain_recursive_forest():
    rng = np.random.default_rng(0)
    past = rng.normal(0, 1, (500, 2))
    points = np.array([[8.0, 8.0], [0.0, 0.0], [2.0, -1.0]])

    def depth(s, x, level, height):
        if level >= height or len(s) <= 1:
            return level + float(sampling.average_path(len(s)))
        d = rng.integers(2)
        c = rng.uniform(s[:, d].min(), s[:, d].max())
        side = s[:, d] <= c
        return depth(s[side] if x[d] <= c else s[~side], x, level + 1, height)

    got = sampling.isolation_scores(past, points, 300, 64, 1)
    for x, score in zip(points, got):
        mean = np.mean([depth(past[rng.choice(500, 64, replace=False)], x, 0, 6) for _ in range(300)])
        assert score == pytest.approx(2 ** (-mean / float(sampling.average_path(64))), abs=0.03)


def test_folds(spark):
    ts = pd.DataFrame({"ts": pd.date_range("2024-01-01", periods=2400, freq="5min")})
    d = spark.createDataFrame(ts)
    f = folds.purged_folds(d, "ts", 5, DAY)
    got = f.toPandas()
    assert not ((got.fold_id == 0) & (got.split == "train")).any()
    assert folds.check_folds(f, DAY).where("not passed").count() == 0
    counts = {(r["fold_id"], r["split"]): r["n"] for r in folds.fold_counts(folds.assign_folds(d, f)).collect()}
    assert all(counts[(k, "val")] == 480 for k in range(5))
    assert counts[(2, "train")] == 960 - 288
    w = folds.walkforward_folds(d, "ts", 3, 16, 8, 50, 100, 40)
    c = {(r["fold_id"], r["split"]): r["n"] for r in folds.fold_counts(folds.assign_folds(d, w)).collect()}
    assert [c[(k, "oos")] for k in range(3)] == [100] * 3 and [c[(k, "val")] for k in range(3)] == [40] * 3
    with pytest.raises(ValueError, match="too short"):
        folds.walkforward_folds(d.limit(100), "ts", 3, 16, 8, 50, 100, 40)
    no_val = w.where("split <> 'val'")
    filled = folds.fill_missing_val(no_val, d, "ts", FIVE, 40, 50 * FIVE)
    c = {(r["fold_id"], r["split"]): r["n"] for r in folds.fold_counts(folds.assign_folds(d, filled)).collect()}
    assert [c[(k, "val")] for k in range(3)] == [40] * 3


def test_mask_and_set_checks(spark):
    from tsforge.operators.quality import set_checks

    rows = spark.createDataFrame([("A", i, i % 2) for i in range(10)], "symbol string, ts int, keep int")
    checks = set_checks(rows.where("keep = 1"), rows, rows.where("ts > 8"), ["symbol", "ts"]).toPandas().set_index("check")
    assert checks.passed.to_dict() == {"train_outside_mask": True, "mask_in_held_out": False}


def test_sample_is_stable(spark):
    from tsforge.operators.labels import sample_rows

    d = spark.range(1000)
    a = sorted(r["id"] for r in sample_rows(d, ["id"], 20).collect())
    assert a == sorted(r["id"] for r in sample_rows(d.repartition(9), ["id"], 20).collect()) and len(a) == 20
