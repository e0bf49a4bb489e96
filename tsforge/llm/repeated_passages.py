"""Passages that repeat across documents, from a sparse suffix array.

Of all suffixes of all documents only those are kept that start at a minimiser: the word run
with the least hash in a window. Windows are as long as the shortest passage looked for, so each
such passage holds a kept suffix, and equal passages keep the same ones. Suffixes whose first
run occurs in one document only are dropped. The others are sorted over the whole corpus, once
by the words that follow and once by the words that come before, read backwards; each is
compared with its nearest neighbours from other documents, and the match is extended to both
sides. Longer passages are covered by the overlapping matches of their suffixes.

The sort is a range partitioning on the run, the context and the place, so a passage in a third
of all documents spreads over many tasks. A match at the border of two tasks is found from the
few rows at the borders. Among suffixes with one run but nested repeats a longer match can lie
beyond both neighbours; it is then found by another suffix of the passage or reported shorter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsforge.llm.common import exchanges, gram_hashes, released, texts_of, word_hashes, written


@dataclass(frozen=True)
class Repeats:
    """``min_words`` is the shortest passage, ``run`` the words of a minimiser."""

    min_words: int = 50
    run: int = 8
    chunk_rows: int = 20_000


def minimisers(words: np.ndarray, op: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """(positions, run hashes): the leftmost least run of every window of min_words words."""
    if len(words) < op.min_words:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    runs = gram_hashes(words, op.run)
    windows = np.lib.stride_tricks.sliding_window_view(runs, op.min_words - op.run + 1)
    at = np.unique(windows.argmin(axis=1) + np.arange(len(windows)))
    return at, runs[at]


def _suffixes(docs: DataFrame, op: Repeats, id_col: str, text_col: str) -> DataFrame:
    """(h, doc_id, pos) of every kept suffix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [minimisers(word_hashes(t), op) for t in texts_of(batch.column(1))]
            ids = np.repeat(batch.column(0).to_numpy(), [len(p) for p, _ in found])
            pos = np.concatenate([p for p, _ in found]) if found else np.zeros(0, np.int64)
            h = np.concatenate([x for _, x in found]) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids, pa.int64()), pa.array(pos.astype(np.int32))], ["h", "doc_id", "pos"])

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "h long, doc_id long, pos int")


CONTEXT = "h long, doc_id long, pos array<int>, ahead binary, back binary"


def _contexts(docs: DataFrame, kept: DataFrame, op: Repeats, id_col: str, text_col: str) -> DataFrame:
    """(h, doc_id, pos, ahead, back): the min_words words from a suffix on, and those before it, backwards.

    Words are four bytes of their hash, big end first, so binary order is a fixed word order.
    Places of one document with equal words around them share a row, so that a text that
    repeats itself gives few.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                doc = batch.column(0)[row].as_py()
                words = (word_hashes(texts_of(batch.column(1).slice(row, 1))[0]) >> np.uint64(32)).astype(">u4")
                turned = words[::-1]
                pos = np.array(batch.column(2)[row].as_py(), np.int64)
                n = len(words)
                places: dict[tuple[int, bytes, bytes], list[int]] = {}
                for p, h in zip(pos.tolist(), batch.column(3)[row].as_py()):
                    around = h, words[p : p + op.min_words].tobytes(), turned[n - p : n - p + op.min_words].tobytes()
                    places.setdefault(around, []).append(p)
                h, ahead, back = zip(*places)
                arrays = [pa.array(h, pa.int64()), pa.array(np.full(len(h), doc)), pa.array(list(places.values()), pa.list_(pa.int32())), pa.array(ahead, pa.binary()), pa.array(back, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["h", "doc_id", "pos", "ahead", "back"])

    by_doc = kept.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", "h"))).alias("s"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = texts.join(by_doc, "doc_id").select("doc_id", "text", F.col("s.pos").alias("pos"), F.col("s.h").alias("h"))
    return rows.mapInArrow(run, CONTEXT)


def _shared(rows: list[bytes], other: list[bytes], width: int) -> np.ndarray:
    """Leading words that each pair of contexts has in common."""
    pad = lambda xs: np.frombuffer(b"".join(x.ljust(4 * width, b"\0") for x in xs), ">u4").reshape(len(xs), width)
    sizes = np.array([[len(a), len(b)] for a, b in zip(rows, other)]).reshape(-1, 2).min(axis=1) // 4
    differ = pad(rows) != pad(other)
    return np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), width), sizes)


def _joined(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching matches of the same two documents as one."""
    if not len(doc):
        return doc, lo, hi, other
    o = np.lexsort((lo, other, doc))
    doc, lo, hi, other = doc[o], lo[o], hi[o], other[o]
    fresh = np.r_[True, (doc[1:] != doc[:-1]) | (other[1:] != other[:-1])]
    pair = np.cumsum(fresh)
    reach = np.maximum.accumulate(hi + pair * 2**32) - pair * 2**32
    start = np.flatnonzero(fresh | np.r_[True, lo[1:] > reach[:-1]])
    return doc[start], lo[start], np.maximum.reduceat(hi, start), other[start]


def _compare(table: pa.Table, op: Repeats) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc_id, lo, hi, other) of suffixes that match their nearest row of another document on either side."""
    h, doc = (table.column(c).to_numpy() for c in ("h", "doc_id"))
    places = table.column("pos").combine_chunks()
    places = places.chunk(0) if isinstance(places, pa.ChunkedArray) else places
    first, place = places.offsets.to_numpy()[:-1] - places.offsets[0].as_py(), places.flatten().to_numpy().astype(np.int64)
    many = places.value_lengths().to_numpy()

    def spans(at: np.ndarray, left: np.ndarray, right: np.ndarray, partner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        count = many[at]
        row = np.repeat(np.arange(len(at)), count)
        p = place[np.repeat(first[at], count) + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)]
        return doc[at][row], p - left[row], p + right[row], doc[partner][row]

    ahead, back = table.column("ahead").to_pylist(), table.column("back").to_pylist()
    n = len(doc)
    new = np.r_[True, doc[1:] != doc[:-1]]
    number = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    ends = np.r_[starts[1:], n]
    row = np.arange(n)
    found = []
    for partner in (starts[number] - 1, ends[number]):
        ok = (partner >= 0) & (partner < n)
        a, b = row[ok], partner[ok]
        same = h[a] == h[b]
        a, b = a[same], b[same]
        right = _shared([ahead[i] for i in a], [ahead[i] for i in b], op.min_words)
        left = _shared([back[i] for i in a], [back[i] for i in b], op.min_words)
        hit = left + right >= op.min_words
        a, b, left, right = a[hit], b[hit], left[hit], right[hit]
        # A match holds for both rows, though the other one may have a nearer neighbour.
        found += [spans(a, left, right, b), spans(b, left, right, a)]
    return _joined(*(np.concatenate(x) for x in zip(*found)))


def _matches(contexts: DataFrame, op: Repeats, order: list[str]) -> DataFrame:
    """(doc_id, lo, hi, other) of matches between neighbours in one order of all suffixes."""
    names = [f.name for f in contexts.schema.fields]

    def edge(table: pa.Table, first: bool) -> pa.Table:
        """The rows of the first (or last) document of a task and the row next to them."""
        doc = table.column("doc_id").to_numpy()
        other = np.flatnonzero(doc != doc[0 if first else -1])
        if not len(other):
            return table
        return table.slice(0, other[0] + 1) if first else table.slice(other[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(kind: int, matches=None, rows: pa.Table | None = None) -> Iterator[pa.RecordBatch]:
            if matches is not None:
                doc, lo, hi, other = matches
                n = len(doc)
                columns = {"kind": np.full(n, 0, np.int32), "doc_id": doc, "lo": lo.astype(np.int32), "hi": hi.astype(np.int32), "other": other}
                table = pa.table(columns)
                for name in ("h", "pos", "ahead", "back"):
                    table = table.append_column(name, pa.nulls(n, contexts_types[name]))
            else:
                n = rows.num_rows
                table = rows.append_column("kind", pa.array(np.full(n, 1, np.int32)))
                for name, kind in (("lo", pa.int32()), ("hi", pa.int32()), ("other", pa.int64())):
                    table = table.append_column(name, pa.nulls(n, kind))
            yield from table.select(["kind", "doc_id", "lo", "hi", "other", "h", "pos", "ahead", "back"]).combine_chunks().to_batches()

        contexts_types = {"h": pa.int64(), "pos": pa.list_(pa.int32()), "ahead": pa.binary(), "back": pa.binary()}
        held, size, before, started = [], 0, None, False
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < op.chunk_rows:
                continue
            table = pa.Table.from_batches(held).select(names)
            table = pa.concat_tables([before, table]) if before is not None else table
            yield from out(0, matches=_compare(table, op))
            if not started:
                yield from out(1, rows=edge(table, True))
                started = True
            before, held, size = edge(table, False), [], 0
        if size or before is not None:
            table = pa.Table.from_batches(held).select(names) if held else None
            table = before if table is None else table if before is None else pa.concat_tables([before, table])
            if table.num_rows:
                yield from out(0, matches=_compare(table, op))
                if not started:
                    yield from out(1, rows=edge(table, True))
                yield from out(1, rows=edge(table, False))

    spread = contexts.repartitionByRange(exchanges(contexts.sparkSession), *order, "doc_id", "pos")
    both = spread.sortWithinPartitions(*order, "doc_id", "pos").mapInArrow(run, "kind int, doc_id long, lo int, hi int, other long, h long, pos array<int>, ahead binary, back binary")
    both = written(both, "matches")

    def borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if tables:
            doc, lo, hi, other = _compare(pa.concat_tables(tables), op)
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), pa.array(other)], ["doc_id", "lo", "hi", "other"])

    # A few rows per task of the sort, not per row of data.
    edges = both.where("kind = 1").select(*names).distinct().coalesce(1).sortWithinPartitions(*order, "doc_id", "pos")
    return both.where("kind = 0").select("doc_id", "lo", "hi", "other").unionByName(edges.mapInArrow(borders, "doc_id long, lo int, hi int, other long"))


def repeated_passages(docs: DataFrame, op: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start_word, end_word, other_doc_id): spans of words that another document has too.

    Spans are half-open counts of words ``[^\\x20\\x09-\\x0D]+`` from 0, at least ``min_words``
    long; overlapping and touching matches of a document are one span. other_doc_id is the least
    document seen to share a part of it. Null, empty and short texts, and repeats inside one
    document only, give no row. Rows with a null id take no part; equal ids are one document.
    """
    spark = docs.sparkSession
    suffixes = written(_suffixes(docs, op, id_col, text_col), "suffixes")
    runs = suffixes.groupBy("h").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("h")
    kept = suffixes.join(runs, "h")
    contexts = written(_contexts(docs, kept, op, id_col, text_col), "contexts")
    released(spark)
    found = _matches(contexts, op, ["h", "ahead"])
    released(spark)
    found = found.unionByName(_matches(contexts, op, ["h", "back"]))
    line = Window.partitionBy("doc_id").orderBy("lo", "hi")
    reach = F.max("hi").over(line.rowsBetween(Window.unboundedPreceding, -1))
    found = found.withColumn("new", F.when(F.col("lo") <= reach, 0).otherwise(1)).withColumn("span", F.sum("new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    spans = found.groupBy("doc_id", "span").agg(F.min("lo").alias("start_word"), F.max("hi").alias("end_word"), F.min("other").alias("other_doc_id"))
    return spans.drop("span")
