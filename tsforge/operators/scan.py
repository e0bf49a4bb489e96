"""Left-to-right state machines over long series.

A policy with memory needs the state at the end of everything before a row. Each chunk is
run in parallel from a guessed start state (the initial one); chunks whose predecessor
ended in another state than guessed are run again from that state, until nothing changes.
After round n the first n chunks are certainly right, so the result is exact; state
machines that forget (positions close, sums return to zero) settle after a few rounds,
and only the chunks still in doubt are run again. A single-chunk series needs one pass.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.operators.layout import Axis, owned, split
from tsforge.session import cut_lineage, measured

# (time-ordered rows, state) -> (one row of new columns per row, new state)
Runner = Callable[[pd.DataFrame, dict], tuple[pd.DataFrame, dict]]


def run_states(df: DataFrame, axis: Axis, runner: Runner, initial: dict, outputs: dict[str, str]) -> DataFrame:
    """Append the columns ``runner`` computes while carrying its state along each series."""
    keys, order = axis.keys, ["_us", *axis.ties]
    start = json.dumps(initial)
    new = T._parse_datatype_string(",".join(f"`{n}` {t}" for n, t in outputs.items())).fields

    def emit(pieces: DataFrame) -> DataFrame:
        kept = [f for f in pieces.schema.fields if f.name != "_in"]
        names = [f.name for f in kept]

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(order, kind="stable").reset_index(drop=True)
            cols, _ = runner(pdf, json.loads(pdf["_in"].iloc[0]))
            return pd.concat([pdf[names], cols[list(outputs)]], axis=1)

        return owned(pieces.groupBy(*keys, "_chunk").applyInPandas(run, T.StructType([*kept, *new])))

    pieces, several = split(df, axis)
    if not several:
        return emit(pieces.withColumn("_in", F.lit(start)))

    pieces = cut_lineage(pieces)
    chunks = pieces.select(*keys, "_chunk").distinct()
    before = F.lag("_chunk").over(Window.partitionBy(*keys).orderBy("_chunk"))
    chunks = measured(chunks.withColumn("_prev", before))
    ends_schema = T.StructType([pieces.schema[c] for c in (*keys, "_chunk")]).add("_in", "string").add("_out", "string")

    def end(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable").reset_index(drop=True)
        first = pdf["_in"].iloc[0]
        _, state = runner(pdf, json.loads(first))
        return pdf[[*keys, "_chunk"]].iloc[:1].assign(_in=first, _out=json.dumps(state))

    todo = measured(chunks.select(*keys, "_chunk", F.lit(start).alias("_in")))
    ends = None
    while todo.count():
        fresh = pieces.join(todo, [*keys, "_chunk"]).groupBy(*keys, "_chunk").applyInPandas(end, ends_schema)
        if ends is not None:
            fresh = fresh.unionByName(ends.join(todo.select(*keys, "_chunk"), [*keys, "_chunk"], "left_anti"))
        ends = cut_lineage(fresh)
        prior = ends.select(*keys, F.col("_chunk").alias("_prev"), F.col("_out").alias("_need"))
        linked = ends.join(chunks, [*keys, "_chunk"]).join(prior, [*keys, "_prev"], "left")
        due = F.coalesce("_need", F.lit(start))
        todo = measured(linked.where(due != F.col("_in")).select(*keys, "_chunk", due.alias("_in")))
    return emit(pieces.join(measured(ends.select(*keys, "_chunk", "_in")), [*keys, "_chunk"]))
