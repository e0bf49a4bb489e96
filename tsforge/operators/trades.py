"""Entries that block later entries: who enters, when it ends, what each row is to it.

A candidate row, once taken, is busy until its exit row and for a fixed time after its entry; the
next candidate after both is taken next. So every candidate points to the one that would follow it,
and the entries are the chain from the first candidate. Nothing is replayed row by row:

1. In each chunk all candidates find their exit at once (sparse tables, :mod:`touch`). Those that
   do not end in their chunk look for the first later chunk whose extremes end them, then for the
   row among that chunk's records (rows that are new extremes).
2. Each chunk follows its candidates to where their chain leaves it. Many chains run together,
   so a chunk has few exits; each is a node that lands on a candidate of a later chunk.
3. The nodes on the real chain are found by pointer doubling: ten rounds for a thousand chunks.
4. Each chunk marks its rows from its landing candidate and the last entry before it.

A series of one chunk needs none of this but step 4. Groups hold the rows of one chunk, or what
one chunk sends to another; a chunk whose exits lie later reads one summary row of each later chunk.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.operators.layout import Axis, owned, split
from tsforge.operators.touch import Maxima, first_at_most, last_of_chain, reached
from tsforge.session import cut_lineage, measured

NEVER = 1 << 62  # a power of two, so it stays whole as a float beside nulls
STOP, TARGET, STALE = 1, 2, 3
SKIP = 2  # the rows after its own that a chunk also searches, so that an early exit has its third row


@dataclass(frozen=True)
class Rule:
    """How candidates block: for ``busy_us`` after the entry, with ``exits`` also until a barrier.

    ``stale`` adds an exit at the first of the third and later rows whose close has not moved in
    favour. ``mark`` gives each candidate of time-ordered rows a row to be marked, or NEVER.
    """

    busy_us: int
    exits: bool = True
    stale: bool = False
    ahead_us: int = 0
    mark: Callable[[pd.DataFrame, np.ndarray], np.ndarray] | None = None


def ends_in(table: dict[str, np.ndarray], asks: dict[str, np.ndarray], start: np.ndarray, later: np.ndarray, stale: bool) -> tuple[np.ndarray, np.ndarray]:
    """Place and kind of the first row of ``table`` that ends each ask: the stop first, then the target, then stale.

    ``table``: low, high, least and most close of rows (or of pieces of the series). ``later``: where the
    search for stale rows starts. The place is the length of the table if nothing ends it.
    """
    low, high = Maxima(-table["low"]), Maxima(table["high"])
    up, n = asks["up"], low.size
    stop = np.where(up, first_at_most(low, start, asks["sl"]), high.first_at_least(start, asks["sl"]))
    target = np.where(up, high.first_at_least(start, asks["tp"]), first_at_most(low, start, asks["tp"]))
    none = np.full(len(up), n)
    old = none
    if stale:
        fell, rose = Maxima(-table["least"]), Maxima(table["most"])
        old = np.where(up, first_at_most(fell, later, asks["close"]), rose.first_at_least(later, asks["close"]))
    place = np.minimum(np.minimum(stop, target), old)
    kind = np.where(place == n, 0, np.where(stop == place, STOP, np.where(target == place, TARGET, STALE)))
    return place, kind


def _ordered(pdf: pd.DataFrame, order: list[str]) -> tuple[pd.DataFrame, int]:
    """A chunk's own rows in order with the rows after them, and how many are its own."""
    pdf = pdf.sort_values(order, kind="stable").reset_index(drop=True)
    own = np.flatnonzero(pdf["_own"].to_numpy())
    if not len(own):
        return pdf.iloc[:0], 0
    return pdf.iloc[own[0] :].reset_index(drop=True), len(own)


def _candidates(rows: pd.DataFrame, own: int, rule: Rule) -> pd.DataFrame:
    """pos, us, end (position or NEVER), kind, mark, up, tp, sl, close of the candidates among the first ``own`` rows."""
    at = np.flatnonzero(rows["_cand"].to_numpy(dtype=bool)[:own])
    base = int(rows["_base"].iloc[0]) if len(rows) else 0
    asks = {c: rows[f"_{c}"].to_numpy()[at] for c in ("up", "tp", "sl")}
    asks["up"] = asks["up"].astype(bool)
    asks |= {c: asks[c].astype(float) for c in ("tp", "sl")}
    asks["close"] = rows["close"].to_numpy(dtype=float)[at]
    end, kind = at + base, np.zeros(len(at), np.int64)
    if rule.exits:
        view = rows.iloc[: own + SKIP]
        close = view["close"].to_numpy(dtype=float)
        table = {"low": view["low"].to_numpy(dtype=float), "high": view["high"].to_numpy(dtype=float), "least": close, "most": close}
        place, kind = ends_in(table, asks, at + 1, at + 3, rule.stale)
        end = np.where(kind > 0, place + base, NEVER)
    mark = np.full(len(at), NEVER) if rule.mark is None else rule.mark(rows, at)
    mark = np.where(mark == NEVER, NEVER, mark + base)
    return pd.DataFrame({"pos": at + base, "us": rows["_us"].to_numpy()[at], "end": end, "kind": kind, "mark": mark, **asks})


def _following(cand: pd.DataFrame, rule: Rule) -> np.ndarray:
    """The candidate each one is followed by; their number if none here."""
    pos, us, end = (cand[c].to_numpy() for c in ("pos", "us", "end"))
    free = np.searchsorted(us, us + rule.busy_us, side="left")
    after = np.where(end == NEVER, len(pos), np.searchsorted(pos, np.where(end == NEVER, 0, end), side="right"))
    return np.maximum(free, after)


CODES = {0: "free", 1: "enter", 2: "busy", 3: "stop", 4: "target", 5: "stale", 6: "wait", 7: "mark"}


def _marked(rows: pd.DataFrame, cand: pd.DataFrame, landing: int, before: dict | None, rule: Rule) -> np.ndarray:
    """The code of each row, given the first entry of the chunk (NEVER: none) and the last one before it."""
    pos = rows["_base"].to_numpy() + np.arange(len(rows)) if len(rows) else np.zeros(0, np.int64)
    us = rows["_us"].to_numpy()
    start = np.searchsorted(cand["pos"].to_numpy(), landing) if landing != NEVER else len(cand)
    taken = cand[reached(np.array([start]), _following(cand, rule))] if len(cand) else cand
    columns = {c: taken[c].to_numpy().astype(np.int64) for c in ("pos", "us", "end", "kind", "mark")}
    if before is not None:
        columns = {c: np.r_[np.int64(before[c]), v] for c, v in columns.items()}
    if not len(columns["pos"]):
        return np.zeros(len(rows), np.int64)
    g = np.searchsorted(columns["pos"], pos, side="right") - 1
    own = {c: v[np.maximum(g, 0)] for c, v in columns.items()}
    out = np.where(us - own["us"] < rule.busy_us, np.where(pos == own["mark"], 7, 6), 0)
    if rule.exits:
        out = np.where(pos < own["end"], 2, np.where(pos == own["end"], 2 + own["kind"], out))
    out = np.where(pos == own["pos"], 1, out)
    return np.where(g < 0, 0, out)


def entries(df: DataFrame, axis: Axis, rule: Rule, out: str = "_role") -> DataFrame:
    """``df`` with ``out``: what each row is to the entry that governs it, one of CODES' names.

    Needs _us-free columns close and, with exits, high and low; _cand (may enter), _up, _tp and _sl of
    the entry it would be. free: nothing blocks; enter; busy: before the exit; stop, target, stale: the exit row;
    wait: after the exit but blocked; mark: the row a rule marks, instead of wait.
    """
    keys, order = axis.keys, ["_us", *axis.ties]
    pieces, several = split(df, axis, ahead=SKIP if rule.exits else 0, ahead_us=rule.ahead_us)
    kept = pieces.schema.fields
    names = [f.name for f in kept]
    schema = T.StructType([*kept, T.StructField(out, T.StringType())])

    def named(rows: pd.DataFrame, codes: np.ndarray) -> pd.DataFrame:
        return rows[names].assign(**{out: pd.Series(codes).map(CODES).to_numpy() if len(codes) else []})

    if not several:

        def whole(pdf: pd.DataFrame) -> pd.DataFrame:
            rows, own = _ordered(pdf, order)
            cand = _candidates(rows, own, rule)
            first = int(cand["pos"].iloc[0]) if len(cand) else NEVER
            return named(rows, _marked(rows, cand, first, None, rule))

        return owned(pieces.groupBy(*keys, "_chunk").applyInPandas(whole, schema))

    pieces = cut_lineage(pieces)
    here = [*keys, "_chunk"]
    key_fields = [pieces.schema[c] for c in here]
    fields = "pos long, us long, end long, kind long, mark long, up boolean, tp double, sl double, close double"
    cand_schema = T.StructType([*key_fields, *T._parse_datatype_string(fields).fields])

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, own = _ordered(pdf, order)
        cand = _candidates(rows, own, rule)
        return pd.concat([pd.concat([pdf[here].iloc[:1]] * len(cand), ignore_index=True), cand], axis=1) if len(cand) else pd.DataFrame(columns=cand_schema.names)

    cand = cut_lineage(pieces.groupBy(*here).applyInPandas(find, cand_schema))
    if rule.exits:
        cand = cut_lineage(_resolved(pieces, cand, keys, order, rule))

    # Where the chain from each candidate leaves its chunk: at the chunk's last candidate on it.
    chain_schema = T.StructType([*cand_schema.fields, T.StructField("leave", T.LongType())])

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos").reset_index(drop=True)
        return pdf.assign(leave=pdf["pos"].to_numpy()[last_of_chain(_following(pdf, rule))])

    chained = cut_lineage(cand.groupBy(*here).applyInPandas(chain, chain_schema))
    entered = ["pos", "us", "end", "kind", "mark"]
    nodes = chained.where("pos = leave").select(*here, *entered)
    start = chained.select(*keys).distinct().select(*keys, F.lit(-1).cast("long").alias("_chunk"), F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("long").alias("us"), F.lit(-1).cast("long").alias("end"), F.lit(0).cast("long").alias("kind"), F.lit(NEVER).alias("mark"))
    nodes = nodes.unionByName(start)
    last = chained.groupBy(*here).agg(F.max("pos").alias("_last"), F.max("us").alias("_last_us"))
    need_us = F.coalesce(F.col("us") + F.lit(rule.busy_us), F.lit(-(2**62)))
    seeks = nodes.where(F.col("end") < NEVER).select(*keys, F.col("_chunk").alias("_from"), F.col("pos").alias("_of"), (F.col("end") + 1).alias("_need"), need_us.alias("_need_us"))
    land = None
    for need, most in (("_need", "_last"), ("_need_us", "_last_us")):  # the first chunk whose last candidate is late enough
        asked = seeks.select(*keys, "_from", "_of", F.col(need).alias("_v"), F.lit(None).cast("long").alias("_chunk"))
        both = asked.unionByName(last.select(*keys, F.col(most).alias("_v"), "_chunk"), allowMissingColumns=True)
        falling = Window.partitionBy(*keys).orderBy(F.desc("_v"), F.col("_from").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
        both = both.withColumn("_chunk", F.last("_chunk", ignorenulls=True).over(falling)).where("_from IS NOT NULL AND _chunk IS NOT NULL")
        both = both.select(*keys, "_from", "_of", F.col("_chunk").alias(f"_at{most}"))
        land = both if land is None else land.join(both, [*keys, "_from", "_of"])
    land = land.join(seeks, [*keys, "_from", "_of"]).withColumn("_chunk", F.greatest("_at_last", "_at_last_us"))
    step = land.join(chained.select(*here, "pos", "us", "leave"), here).where("pos >= _need AND us >= _need_us")
    step = step.groupBy(*keys, "_from", "_of", "_chunk").agg(F.min(F.struct("pos", "leave")).alias("_hit"))
    step = cut_lineage(step.select(*keys, "_from", "_of", F.col("_chunk").alias("_to"), F.col("_hit.pos").alias("_landing"), F.col("_hit.leave").alias("_leave")))

    # Pointer doubling from the start of each series.
    link = step.select(*keys, F.col("_from").alias("_a"), F.col("_of").alias("_b"), F.col("_to").alias("_c"), F.col("_leave").alias("_d"))
    real = cut_lineage(start.select(*keys, F.col("_chunk").alias("_a"), F.col("pos").alias("_b")))
    count, rounds = real.count(), 0
    while True:
        ahead = real.join(link, [*keys, "_a", "_b"]).select(*keys, F.col("_c").alias("_a"), F.col("_d").alias("_b"))
        real = cut_lineage(real.unionByName(ahead).distinct())
        now, rounds = real.count(), rounds + 1
        if now == count:
            break
        count = now
        second = link.select(*keys, F.col("_a").alias("_c"), F.col("_b").alias("_d"), F.col("_c").alias("_e"), F.col("_d").alias("_f"))
        link = cut_lineage(link.join(second, [*keys, "_c", "_d"]).select(*keys, "_a", "_b", F.col("_e").alias("_c"), F.col("_f").alias("_d")))
    entries.rounds = rounds

    landing = step.join(real.withColumnsRenamed({"_a": "_from", "_b": "_of"}), [*keys, "_from", "_of"]).select(*keys, F.col("_to").alias("_chunk"), "_landing")
    known = nodes.join(real.select(*keys, F.col("_a").alias("_chunk"), F.col("_b").alias("pos")), [*here, "pos"]).where("_chunk >= 0")
    known = known.select(*here, F.struct(*entered).alias("_entry"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    info = pieces.select(*here).distinct().join(known, here, "left").withColumn("_before", F.last("_entry", ignorenulls=True).over(before))
    info = info.join(landing, here, "left").select(*here, *[F.col(f"_before.{c}").alias(c) for c in entered], F.coalesce("_landing", F.lit(NEVER)).alias("landing"))
    told = cand.select(*here, *entered, F.lit(None).cast("long").alias("landing")).unionByName(info)

    def emit(rows: pd.DataFrame, side: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame(columns=schema.names)
        rows, own = _ordered(rows, order)
        rows = rows.iloc[:own].reset_index(drop=True)
        about = side[side["landing"].notna()].iloc[0]
        mine = side[side["landing"].isna()].sort_values("pos").reset_index(drop=True)
        mine = mine.astype({c: "int64" for c in entered})
        prior = None if pd.isna(about["pos"]) else {c: int(about[c]) for c in entered}
        return named(rows, _marked(rows, mine, int(about["landing"]), prior, rule))

    own_rows = pieces.groupBy(*here).cogroup(measured(told).groupBy(*here)).applyInPandas(emit, schema)
    return owned(own_rows)


def _resolved(pieces: DataFrame, cand: DataFrame, keys: list[str], order: list[str], rule: Rule) -> DataFrame:
    """``cand`` with the exits found that lie in later chunks."""
    here = [*keys, "_chunk"]
    record_schema = T.StructType([*[pieces.schema[c] for c in here], *T._parse_datatype_string("place long, low double, high double, least double, most double").fields])

    def records(pdf: pd.DataFrame) -> pd.DataFrame:
        """Rows that are new extremes of what a chunk searches: its own from the third on and the two after."""
        rows, own = _ordered(pdf, order)
        view = rows.iloc[SKIP : own + SKIP]
        low, high, close = (view[c].to_numpy(dtype=float) for c in ("low", "high", "close"))
        new = np.zeros(len(view), bool)
        for values in (-low, high, *((-close, close) if rule.stale else ())):
            values = np.where(np.isnan(values), -np.inf, values)
            new |= values > np.r_[-np.inf, np.maximum.accumulate(values)[:-1]] if len(values) else new
        at = np.flatnonzero(new)
        made = pd.DataFrame({"place": int(rows["_base"].iloc[0]) + SKIP + at if len(rows) else at, "low": low[at], "high": high[at], "least": close[at], "most": close[at]})
        return pd.concat([pd.concat([pdf[here].iloc[:1]] * len(made), ignore_index=True), made], axis=1) if len(made) else pd.DataFrame(columns=record_schema.names)

    found = cut_lineage(pieces.groupBy(*here).applyInPandas(records, record_schema))
    pending = cand.where(F.col("end") == NEVER).select(*keys, F.col("_chunk").alias("_from"), "pos", "up", "tp", "sl", "close")
    edges = found.groupBy(*here).agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min("least").alias("least"), F.max("most").alias("most"))
    sources = pending.select(*keys, "_from").distinct()
    later = sources.join(edges, keys).where("_chunk > _from").select(*keys, "_from", F.col("_chunk").alias("place"), "low", "high", "least", "most")

    def search(asks: DataFrame, tables: DataFrame, groups: list[str]) -> DataFrame:
        """``asks`` with place and kind of what ends them in their group's table; those that go on are left out."""
        schema = T.StructType([*asks.schema.fields, T.StructField("place", T.LongType()), T.StructField("kind", T.LongType())])

        def run(a: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
            if not len(a) or not len(t):
                return pd.DataFrame(columns=schema.names)
            t = t.sort_values("place").reset_index(drop=True)
            table = {c: t[c].to_numpy(dtype=float) for c in ("low", "high", "least", "most")}
            zero = np.zeros(len(a), np.int64)
            asked = {"up": a["up"].to_numpy(dtype=bool), **{c: a[c].to_numpy(dtype=float) for c in ("tp", "sl", "close")}}
            at, kind = ends_in(table, asked, zero, zero, rule.stale)
            hit = kind > 0
            return a[hit].assign(place=t["place"].to_numpy()[at[hit]], kind=kind[hit])

        return asks.groupBy(*groups).cogroup(measured(tables).groupBy(*groups)).applyInPandas(run, schema)

    chunk = search(pending, later, [*keys, "_from"]).drop("kind").withColumnRenamed("place", "_chunk")
    chunk = cut_lineage(chunk)
    pairs = chunk.select(*keys, "_chunk", "_from").distinct()
    done = search(chunk, found.join(pairs, here), [*keys, "_chunk", "_from"])
    done = done.select(*keys, F.col("_from").alias("_chunk"), "pos", F.col("place").alias("_end"), F.col("kind").alias("_kind"))
    joined = cand.join(done, [*here, "pos"], "left")
    return joined.withColumns({"end": F.coalesce("_end", "end"), "kind": F.coalesce("_kind", "kind")}).drop("_end", "_kind").select(*cand.columns)
