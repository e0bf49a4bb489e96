"""Keyed state in streams: the batch state machines, one micro-batch at a time."""

from __future__ import annotations

import json
import pickle
import tempfile
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import IO

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tsforge.functions.timeunits import micros
from tsforge.operators.scan import Runner

STATE_VERSION = 2  # rows that wait for the watermark are held in numbered pieces
RUN_ROWS = 50_000
STEP_ROWS = 1000
MOST_RUNS = 50
ARRIVAL = "_arrival"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _run_file(pieces: Iterable[pd.DataFrame]) -> IO[bytes]:
    """Rows in order in a file of the worker's own temp folder, ``STEP_ROWS`` at a time; it goes with its last reader."""
    file = tempfile.TemporaryFile()
    for piece in pieces:
        for at in range(0, len(piece), STEP_ROWS):
            pickle.dump(piece.iloc[at : at + STEP_ROWS], file, protocol=5)
    return file


def _read_back(file: IO[bytes], steps: int) -> Iterator[pd.DataFrame]:
    """The rows of a run file, ``steps`` steps at a time."""
    file.seek(0)
    parts = []
    while True:
        try:
            parts.append(pickle.load(file))
        except EOFError:
            break
        if len(parts) == steps:
            yield pd.concat(parts, ignore_index=True)
            parts = []
    if parts:
        yield pd.concat(parts, ignore_index=True)


def _merged(runs: list[IO[bytes]], order: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of sorted run files in one order; of each run a part is in memory, all parts together ``RUN_ROWS`` rows."""
    steps = max(1, RUN_ROWS // (len(runs) * STEP_ROWS))
    parts = [_read_back(run, steps) for run in runs]
    held = [next(p) for p in parts]
    unread = set(range(len(runs)))
    clock = lambda rows: rows[order[0]].to_numpy(dtype=float, na_value=np.inf)
    while unread:
        # Rows before the earliest end of what is read of a run have all come.
        first = min(unread, key=lambda i: clock(held[i])[-1])
        bound = clock(held[first])[-1]
        cuts = [int(np.searchsorted(clock(h), bound, "left")) for h in held]
        rows = pd.concat([h.iloc[:n] for h, n in zip(held, cuts)], ignore_index=True)
        held = [h.iloc[n:] for h, n in zip(held, cuts)]
        more = next(parts[first], None)
        if more is None:
            unread.discard(first)
        else:
            held[first] = pd.concat([held[first], more], ignore_index=True)
        if len(rows):
            yield rows.sort_values(order, ignore_index=True)
    rows = pd.concat(held, ignore_index=True)
    if len(rows):
        yield rows.sort_values(order, ignore_index=True)


def in_order(parts: Iterable[pd.DataFrame], order: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of ``parts`` by ``order``, a number first, and then as they came, piece by piece.

    About ``RUN_ROWS`` rows are in memory at once however many come; beyond that, sorted runs wait in files
    of the worker and are merged, ``MOST_RUNS`` at a time.
    """
    order, levels, held, size, came = [*order, ARRIVAL], [[]], [], 0, 0

    def sorted_rows() -> pd.DataFrame:
        return pd.concat(held, ignore_index=True).sort_values(order, ignore_index=True)

    for part in parts:
        if not len(part):
            continue
        held.append(part.assign(**{ARRIVAL: np.arange(came, came + len(part))}))
        came, size = came + len(part), size + len(part)
        if size >= RUN_ROWS:
            levels[0].append(_run_file([sorted_rows()]))
            held, size = [], 0
        for k, level in enumerate(levels):
            if len(level) == MOST_RUNS:
                if k + 1 == len(levels):
                    levels.append([])
                levels[k + 1].append(_run_file(_merged(level, order)))
                level.clear()
    runs = [run for level in levels for run in level]
    if runs and held:
        runs.append(_run_file([sorted_rows()]))
        held = []
    if runs:
        yield from (rows.drop(columns=ARRIVAL) for rows in _merged(runs, order))
    elif held:
        yield sorted_rows().drop(columns=ARRIVAL)


class _KeyedRunner(StatefulProcessor):
    """Runs a state machine over the rows of one key, piece by piece in time order, and keeps its state as JSON."""

    def __init__(self, runner: Runner, initial: dict, inputs: list[str], names: list[str], outputs: list[str], order: list[str]) -> None:
        self.runner, self.initial = runner, initial
        self.inputs, self.names, self.outputs, self.order = inputs, names, outputs, ["_us", *order]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.saved = handle.getValueState("state", "version int, state string")

    def _named(self, rows: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in rows:
            if len(part):
                part.columns = self.inputs  # the worker renames columns that start with "_"
                yield part

    def _run(self, pieces: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, ran = json.loads(self.saved.get()[1]) if self.saved.exists() else self.initial, False
        for piece in pieces:
            cols, state = self.runner(piece, state)
            ran = True
            yield pd.concat([piece[self.names], cols[self.outputs]], axis=1)
        if ran:
            self.saved.update((STATE_VERSION, json.dumps(state)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        yield from self._run(in_order(self._named(rows), self.order))

    def close(self) -> None:
        pass


class _OrderedRunner(_KeyedRunner):
    """As :class:`_KeyedRunner`, but rows wait in state until the watermark has passed them, and run in time order.

    They wait in numbered pieces of a few ``STEP_ROWS``, of which one is read at a time.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "piece int", "data binary")
        self.count = handle.getValueState("count", "version int, pieces int")

    def _held(self, pieces: int) -> Iterator[pd.DataFrame]:
        for k in range(pieces):
            yield pa.ipc.open_stream(bytes(self.waiting.getValue((k,))[0])).read_pandas()

    def _released(self, fresh: Iterable[pd.DataFrame], watermark_ms: int) -> Iterator[pd.DataFrame]:
        before = self.count.get()[1] if self.count.exists() else 0
        later = tempfile.TemporaryFile()

        def ready() -> Iterator[pd.DataFrame]:
            for piece in in_order(chain(self._held(before), self._named(fresh)), self.order):
                n = int((piece["_us"] <= watermark_ms * 1000).sum())
                for at in range(n, len(piece), STEP_ROWS):
                    pickle.dump(piece.iloc[at : at + STEP_ROWS], later, protocol=5)
                if n:
                    yield piece.iloc[:n]

        yield from self._run(ready())
        # Small pieces of the merge are put together before they go into the state.
        after = 0
        for piece in _read_back(later, 8):
            if not after:
                self.handle.registerTimer(int(piece["_us"].iloc[0]) // 1000 + 1)
            sink = pa.BufferOutputStream()
            table = pa.Table.from_pandas(piece, preserve_index=False)
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            self.waiting.updateValue((after,), (sink.getvalue().to_pybytes(),))
            after += 1
        for k in range(after, before):
            self.waiting.removeKey((k,))
        if after:
            self.count.update((STATE_VERSION, after))
        elif before:
            self.count.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        yield from self._released(rows, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.count.exists():
            yield from self._released([], timerValues.getCurrentWatermarkInMs())


def stream_states(
    sdf: DataFrame, keys: list[str], ts: str, runner: Runner, initial: dict, outputs: dict[str, str], drop: tuple[str, ...] = (), delay: str | None = None, ties: tuple[str, ...] = ()
) -> DataFrame:
    """The streaming form of :func:`tsforge.operators.scan.run_states`: same runner, state kept per key.

    Rows of a micro-batch are handled in order of time and ``ties``, in pieces of about ``RUN_ROWS`` rows, so a worker's
    memory does not grow with a key's rows; the stored state carries its version.
    Such operators can follow one another in one stream. With ``delay`` rows may come out of order by that
    much: they wait in state, at most those of the delay for each key, until the watermark passes them, then
    run in order of time and ``ties``; rows later than the delay are dropped.
    """
    sdf.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    kept = [f for f in sdf.schema.fields if f.name not in drop]
    new = T._parse_datatype_string(",".join(f"`{n}` {t}" for n, t in outputs.items())).fields
    args = (runner, initial, [*sdf.columns, "_us"], [f.name for f in kept], list(outputs))
    machine = (_KeyedRunner if delay is None else _OrderedRunner)(*args, list(ties))
    rows = sdf if delay is None else sdf.withWatermark(ts, delay)
    grouped = rows.withColumn("_us", micros(ts)).groupBy(*keys)
    return grouped.transformWithStateInPandas(machine, T.StructType([*kept, *new]), "Append", "None" if delay is None else "EventTime")


def ffill_runner(cols: list[str], limit: int = 3) -> tuple[Runner, dict, dict[str, str]]:
    """Limited forward fill as a state machine: last value and its age per column."""
    start = {c: [None, 0] for c in cols}
    outputs = {**{f"{c}_filled": "double" for c in cols}, **{f"{c}_imputed": "int" for c in cols}}

    def runner(rows: pd.DataFrame, state: dict) -> tuple[pd.DataFrame, dict]:
        state, out = dict(state), {}
        for c in cols:
            last, age = state[c]
            filled, flags = [], []
            for v in rows[c].astype(float).tolist():
                if v == v:
                    last, age = v, 0
                    filled.append(v)
                    flags.append(0)
                else:
                    age += 1
                    use = last is not None and age <= limit
                    filled.append(last if use else None)
                    flags.append(int(use))
            state[c] = [last, age]
            out[f"{c}_filled"], out[f"{c}_imputed"] = pd.Series(filled, dtype=float), flags
        return pd.DataFrame(out), state

    return runner, start, outputs


def stream_ffill(sdf: DataFrame, keys: list[str], ts: str, cols: list[str], limit: int = 3, delay: str | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    return stream_states(sdf, keys, ts, *ffill_runner(cols, limit), delay=delay, ties=ties)


def policy_runner(cool_us: int, early_exit: bool = False) -> tuple[Runner, dict, dict[str, str]]:
    """The position policy (see :mod:`tsforge.operators.policy`) for streams."""
    from tsforge.operators.policy import POSITION_START, position_step

    cols = ("_us", "high", "low", "close", "_want", "_side", "_tp", "_sl")

    def runner(rows: pd.DataFrame, state: dict) -> tuple[pd.DataFrame, dict]:
        reasons = []
        for row in zip(*[rows[c].tolist() for c in cols]):
            reason, state = position_step(state, *row, cool_us, early_exit)
            reasons.append(reason)
        return pd.DataFrame({"reason": reasons}), state

    return runner, POSITION_START, {"reason": "string"}


def windows_runner(cols: list[str], W: int, featurise=None, reach: int = 0) -> tuple[Runner, dict, dict[str, str]]:
    """Emit the flattened window of W bars that ends at each new bar (NULL until full).

    ``featurise`` maps the bars held so far to feature columns (default: the bars themselves);
    ``reach`` is how many bars before its own a feature depends on. The state keeps what the
    next window needs: W - 1 bars and the reach of the first of them.
    """
    start = {"rows": []}

    def runner(rows: pd.DataFrame, state: dict) -> tuple[pd.DataFrame, dict]:
        old = pd.DataFrame(state["rows"], columns=cols)
        bars = pd.concat([old, rows[cols].astype(float)], ignore_index=True) if len(old) else rows[cols].astype(float)
        feats = bars if featurise is None else featurise(bars)
        values, n = feats.to_numpy(dtype=float), len(old)
        out = [values[n + i - W + 1 : n + i + 1].ravel().tolist() if n + i + 1 >= W else None for i in range(len(rows))]
        keep = bars.tail(W - 1 + reach)
        return pd.DataFrame({"window": pd.Series(out, dtype=object)}), {"rows": keep.to_numpy().tolist()}

    return runner, start, {"window": "array<double>"}


TELEMETRY_START = {"temp": 50.0, "util": 0.0, "throttle": False}


def telemetry_runner(t_max: float = 70.0, u_max: float = 80.0) -> tuple[Runner, dict, dict[str, str]]:
    """Carry the last known temperature and load; throttle when either reaches its limit; flag transitions."""

    def runner(rows: pd.DataFrame, state: dict) -> tuple[pd.DataFrame, dict]:
        temp, util, was = state["temp"], state["util"], state["throttle"]
        out = []
        for t, u in zip(rows["temp_c"].tolist(), rows["gpu_util"].tolist()):
            temp = t if t is not None and t == t else temp
            util = u if u is not None and u == u else util
            now = temp >= t_max or util >= u_max
            out.append((temp, util, int(now), int(now != was)))
            was = now
        return pd.DataFrame(out, columns=["temp", "util", "throttle", "transition"]), {"temp": temp, "util": util, "throttle": bool(was)}

    return runner, TELEMETRY_START, {"temp": "double", "util": "double", "throttle": "int", "transition": "int"}


def parse_telemetry(df: DataFrame, line: str = "line") -> DataFrame:
    """temp_c and gpu_util of a device telemetry line: the last 'NNC' and the last plain number up to 100."""
    text = F.replace(F.replace(F.trim(line), F.lit("%"), F.lit("")), F.lit("@"), F.lit(" "))
    tokens = F.split(text, r"\s+")
    temps = F.filter(tokens, lambda t: t.rlike("^[0-9]+C$"))
    loads = F.filter(tokens, lambda t: t.rlike("^[0-9]+$") & (t.try_cast("double") <= 100))
    last = lambda a: F.get(a, F.size(a) - 1)
    return df.withColumns(
        {"temp_c": F.regexp_replace(last(temps), "C$", "").try_cast("double"), "gpu_util": last(loads).try_cast("double")}
    )
