"""Queries against their SQL on small tables that hold what larger ones bring: ties, dense windows, many rows a key."""

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

import check
from tsforge.catalog import load
from tsforge.operators import sampling
from tsforge.session import scratch_path
from tsforge.streaming import jobs, states


def events(rows, seed=0, days=3, step_us=1):
    """Unordered events on a grid of ``step_us``, ids not in time order."""
    rng = np.random.default_rng(seed)
    us = np.sort(rng.integers(0, days * 86_400_000_000 // step_us, rows)) * step_us
    us = np.datetime64("2024-01-01", "us") + rng.permutation(us).astype("timedelta64[us]")
    kinds = np.array(["click", "view", "error"])[rng.integers(0, 3, rows)]
    return pd.DataFrame({"event_id": np.arange(rows), "ts": us, "user_id": rng.integers(0, 5000, rows), "event_type": kinds, "value": rng.random(rows) * 120, "props": "{}"})


def differences(spark, folder, name, **tables):
    """The rows by which a query and its SQL differ on ``tables``, and how many rows there are."""
    con = duckdb.connect()
    for table, pdf in tables.items():
        pdf.to_parquet(f"{folder}/{table}.parquet", index=False, coerce_timestamps="us")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    queries, oracles = load()
    df = queries[name](spark, str(folder))
    got = check.rows_of(df.columns, df.collect())
    cur = con.execute(oracles[name])
    want = check.rows_of([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    return set(got[1]) ^ set(want[1]), len(want[1])


def test_landed_records_of_one_millisecond_open_and_close_bars_by_id(spark, tmp_path):
    dense = events(2000, days=3)
    dense["ts"] = dense["ts"].dt.floor("2h") + pd.to_timedelta(dense["event_id"] * 617 % 1000, "us")
    wrong, n = differences(spark, tmp_path, "landing_to_lake", events=dense)
    assert n > 50 and not wrong


def test_rows_of_a_key_are_ordered_with_few_in_memory(monkeypatch):
    monkeypatch.setattr(states, "RUN_ROWS", 40)
    monkeypatch.setattr(states, "STEP_ROWS", 5)
    monkeypatch.setattr(states, "MOST_RUNS", 4)
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"_us": rng.integers(0, 300, 1500), "tie": rng.integers(0, 2, 1500), "came": np.arange(1500), "text": "x"})
    pieces = list(states.in_order((pdf.iloc[a : a + 13].reset_index(drop=True) for a in range(0, 1500, 13)), ["_us", "tie"]))
    want = pdf.sort_values(["_us", "tie", "came"], ignore_index=True)
    pd.testing.assert_frame_equal(pd.concat(pieces, ignore_index=True), want)
    assert max(map(len, pieces)) <= 80
    assert list(states.in_order([], ["_us"])) == []


def largest_piece(runner):
    """A state machine that also tells how many rows it was given at once."""
    run, start, outputs = runner

    def told(rows, state):
        cols, after = run(rows, state)
        return cols.assign(piece=len(rows)), after

    return told, start, {**outputs, "piece": "int"}


def test_streams_run_a_key_in_pieces(spark, tmp_path):
    """With many rows a key the machines get bounded pieces, whether rows wait for the watermark or not."""
    pdf = events(states.RUN_ROWS * 4, days=1, step_us=1000).assign(event_type="one")
    pdf.to_parquet(f"{tmp_path}/events.parquet", index=False, coerce_timestamps="us")
    for delay in (None, "1 hour"):
        e = jobs.read_landing(spark, str(tmp_path), "event_id long, ts timestamp_ntz, event_type string, value double", glob="events.parquet")
        e = e.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", F.when(F.col("value") > 60, F.col("value")).alias("v"))
        d = states.stream_states(e, ["event_type"], "ts", *largest_piece(states.ffill_runner(["v"])), delay=delay, ties=("event_id",))
        path = scratch_path(spark, "pieces")
        jobs.run_to_path(d, path, scratch_path(spark, "progress")).awaitTermination()
        got = spark.read.parquet(path).toPandas().sort_values(["ts", "event_id"], ignore_index=True)
        want = pdf[pdf.ts <= (pdf.ts.max() - pd.Timedelta(delay or 0)).floor("ms")].sort_values(["ts", "event_id"], ignore_index=True)
        assert got.event_id.tolist() == want.event_id.tolist()
        filled = want.value.where(want.value > 60).ffill(limit=3)
        assert np.array_equal(got.v_filled, filled, equal_nan=True)
        assert got.piece.max() <= 2 * states.RUN_ROWS


def test_streamed_latency_is_exact_in_dense_windows(spark, tmp_path):
    wrong, n = differences(spark, tmp_path, "streamed_latency", events=events(60_000, days=1))
    assert n > 5 and not wrong


def test_latency_quantiles_leave_missing_values_out(spark):
    d = spark.createDataFrame([(0, 1, "a", None, 3), (0, 1, "a", 2.0, 1), (0, 1, "a", 7.0, 1), (1, 2, "a", None, 2)], "start int, end int, name string, value double, n long")
    got = {r["start"]: (r["n"], r["p50"], r["p99"]) for r in jobs.latency_quantiles(d).collect()}
    assert got == {0: (5, 2.0, 7.0), 1: (2, None, None)}


def test_a_few_queries_read_each_block_of_points_once(spark, monkeypatch):
    """Queries of many blocks share a block of their own, so that points are not sent once for each of them."""
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (600, 16))
    pdf = pd.DataFrame({"id": np.arange(600), "g": "a", "v": list(x)})
    points = spark.createDataFrame(pdf)
    sent = spark.sparkContext.accumulator(0)
    plain = sampling._top_k

    def counted(queries, rows, k, vec):
        sent.add(len(rows))
        return plain(queries, rows, k, vec)

    monkeypatch.setattr(sampling, "_top_k", counted)
    asks = points.where("id % 50 = 0")
    got = sampling.nearest_neighbours(points, ["g"], "v", "id", 5, asks, block_rows=20).toPandas()
    d = np.sqrt(((x[::50, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    d[np.arange(12), np.arange(0, 600, 50)] = np.inf
    order = np.argsort(d, axis=1)[:, :5]
    assert {tuple(r) for r in got[["id", "rank", "nbr"]].itertuples(index=False)} == {(50 * i, j + 1, order[i, j]) for i in range(12) for j in range(5)}
    assert 0 < sent.value <= 600 + 12 * 20  # every point once, and the queries' own blocks


def test_odd_vectors_are_no_neighbours():
    rows = lambda ids, v: pd.DataFrame({"_id": ids, "_v": [np.asarray(x, float) for x in v]})
    points = rows([1, 2, 3, 4], [[0, 0], [np.nan, 0], [3, 4], [1e200, 0]])
    got = sampling._top_k(rows([1, 4], [[0, 0], [1e200, 0]]), points, 5, "_v")
    assert list(got.itertuples(index=False, name=None)) == [(1, 3, 5.0)]
    same = rows(range(9), [[1e200, 0]] * 9)
    assert sampling._top_k(same, same, 2, "_v")["_dist"].tolist() == [0.0] * 18


def test_every_row_asks_for_its_neighbours(spark, tmp_path):
    rng = np.random.default_rng(8)
    vectors = pd.DataFrame({"vec_id": np.arange(1, 41), "embedding": list(rng.normal(0, 1, (40, 64)).astype("float32")), "label": np.arange(40) % 10})
    wrong, n = differences(spark, tmp_path, "exact_neighbours", embeddings=vectors)
    assert n == 5 * 36 + 3 * 4 and not wrong  # one class has four rows


def test_copies_of_several_blocks_have_the_smallest_ids_as_neighbours(spark):
    pdf = pd.DataFrame({"id": np.arange(200)[::-1], "g": "a", "v": [[1.0, 2.0]] * 150 + [[float(i), 0.0] for i in range(50)]})
    got = sampling.nearest_neighbours(spark.createDataFrame(pdf), ["g"], "v", "id", 5, block_rows=20).toPandas()
    assert len(got) == 1000
    for i, part in got[got.id >= 50].groupby("id"):
        assert list(part.sort_values("rank").nbr) == [j for j in range(50, 56) if j != i][:5]
