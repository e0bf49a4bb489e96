"""Documents that hold passages of a benchmark: an FM-index per shard of documents.

A task gathers whole documents into shards of about ``shard_bytes``. A shard's words become
numbers; words and word pairs that no benchmark window has break the text into runs, and runs
shorter than the shortest window are left out. The runs are indexed (:mod:`fm_index`), all windows
are searched backwards at once, occurrences are located by sampled suffix positions, and their
word spans are merged per document. Nothing is shuffled: a document is whole in its shard.

The benchmark reaches the tasks in blocks of about ``block_bytes`` of text, each collected and
broadcast by itself and searched in turn in the shard's index, so no size of it has to fit one place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.llm.common import span_hashes, texts_of, word_spans
from tsforge.llm.fm_index import FMIndex

#: Words are runs of digits, lower-case letters and bytes from 0x80 up, after lower-casing A-Z.
IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True

RESULTS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))),
]


@dataclass(frozen=True)
class Decontamination:
    window: int = 10
    shard_bytes: int = 16 << 20
    block_bytes: int = 4 << 20
    sample: int = 8


def _words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of each word of lower-cased text."""
    parts = [(span_hashes(codes, start, end), start + at, end + at) for at, codes, start, end in word_spans(text, IS_WORD)]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _stretches(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers of each [low, high), and the number of the range each comes from."""
    size = high - low
    owner = np.repeat(np.arange(len(low)), size)
    return np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + low[owner], owner


def windows(items: list[tuple[str | None, str | None]], width: int) -> dict:
    """The distinct windows of some items: ``vocab`` sorted hashes, ``pairs`` sorted, ``phrases`` right-aligned numbers from 1.

    ``owners``, ``owner_at``: which of the sorted ``ids`` have a window; a null id has none.
    """
    ids = sorted({i for i, _ in items if i is not None})
    number = {i: k for k, i in enumerate(ids)}
    texts = [_words((text or "").encode().lower())[0] for _, text in items]
    vocab, codes = np.unique(np.concatenate([*texts, np.zeros(0, np.uint64)]), return_inverse=True)
    rows, owners, at = [], [], 0
    for (item, _), words in zip(items, texts):
        own = codes[at : at + len(words)] + 1
        at += len(words)
        if not len(own):
            continue
        span = min(width, len(own))
        block = np.zeros((len(own) - span + 1, width), np.int64)
        block[:, width - span :] = np.lib.stride_tricks.sliding_window_view(own, span)
        rows.append(block)
        owners.append(np.full(len(block), number.get(item, -1)))
    if not rows:
        return {"vocab": vocab, "phrases": np.zeros((0, width), np.int64)}
    phrases, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    both = np.unique(np.stack([which.ravel(), np.concatenate(owners)], axis=1), axis=0)
    both = both[both[:, 1] >= 0]
    left, right = phrases[:, :-1].ravel(), phrases[:, 1:].ravel()
    return {
        "ids": ids, "vocab": vocab, "phrases": phrases, "shortest": int((phrases > 0).sum(axis=1).min()),
        "pairs": np.unique((left * (len(vocab) + 1) + right)[left > 0]),
        "owners": both[:, 1], "owner_at": np.searchsorted(both[:, 0], np.arange(len(phrases) + 1)),
    }


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The place of each value in the sorted table, or -1."""
    spots = np.zeros(1 << 16, bool)
    spots[table.astype(np.uint64) & np.uint64(0xFFFF)] = True
    out = np.full(len(values), -1, np.int64)
    maybe = np.flatnonzero(spots[values.astype(np.uint64) & np.uint64(0xFFFF)])
    if len(table) and len(maybe):
        place = np.minimum(np.searchsorted(table, values[maybe]), len(table) - 1)
        out[maybe] = np.where(table[place] == values[maybe], place, -1)
    return out


def occurrences(hashes: np.ndarray, doc: np.ndarray, bench: dict, sample: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(word, phrase) of every occurrence of a phrase inside the documents of one shard."""
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(bench["phrases"]):
        return nothing
    known = _among(hashes, bench["vocab"])
    at = np.flatnonzero(known >= 0)
    if not len(at):
        return nothing
    word = known[at] + 1
    near = np.flatnonzero((np.diff(at) == 1) & (doc[at[1:]] == doc[at[:-1]]))
    linked = np.zeros(len(at), bool)  # with the one before
    linked[near + 1] = _among(word[near] * (len(bench["vocab"]) + 1) + word[near + 1], bench["pairs"]) >= 0
    head = np.flatnonzero(~linked)
    length = np.diff(np.r_[head, len(at)])
    head, length = head[length >= bench["shortest"]], length[length >= bench["shortest"]]
    if not len(head):
        return nothing
    picked, run = _stretches(head, head + length)
    present, symbols = np.unique(word[picked], return_inverse=True)
    text = np.zeros(len(picked) + len(head), np.int64)
    origin = np.zeros(len(text), np.int64)
    place = np.arange(len(picked)) + run  # one separator after each run
    text[place], origin[place] = symbols + 1, at[picked]

    local = np.zeros(len(bench["vocab"]) + 1, np.int64)
    local[present] = np.arange(len(present)) + 1
    wanted = np.flatnonzero(((bench["phrases"] == 0) | (local[bench["phrases"]] > 0)).all(axis=1))
    index = FMIndex(text, sample)
    low, high = index.search(local[bench["phrases"][wanted]])
    found = np.flatnonzero(high > low)
    rows, which = _stretches(low[found], high[found])
    return origin[index.locate(rows)], wanted[found[which]]


def _shard(texts: list[bytes], blocks: list, op: Decontamination) -> list[tuple]:
    """The result columns of each document of a shard."""
    whole = b"\n".join(texts).lower()
    hashes, start, end = _words(whole)
    offsets = np.cumsum([0, *[len(t) + 1 for t in texts]])
    doc = np.searchsorted(offsets, start, side="right") - 1
    edge = np.zeros(len(hashes) + 1, np.int64)
    items: dict[int, set[str]] = {}
    for block in blocks:
        bench = block.value
        word, phrase = occurrences(hashes, doc, bench, op.sample)
        if len(word):
            size = (bench["phrases"][phrase] > 0).sum(axis=1)
            np.add.at(edge, word, 1)
            np.add.at(edge, word + size, -1)
            pairs = np.unique(doc[word] * len(bench["phrases"]) + phrase)
            d, p = np.divmod(pairs, len(bench["phrases"]))
            owner, which = _stretches(bench["owner_at"][p], bench["owner_at"][p + 1])
            both = np.unique(d[which] * max(1, len(bench["ids"])) + bench["owners"][owner])
            for k, i in zip(*(x.tolist() for x in np.divmod(both, max(1, len(bench["ids"]))))):
                items.setdefault(k, set()).add(bench["ids"][i])
        if len(blocks) > 1:
            vars(block).pop("_value", None)  # one block at a time in memory
    hit = np.cumsum(edge[:-1]) > 0
    first_word = np.searchsorted(doc, np.arange(len(texts) + 1))
    n_hit = np.bincount(doc[hit], minlength=len(texts)) if len(hit) else np.zeros(len(texts), np.int64)
    out = []
    for k, text in enumerate(texts):
        a, b = int(first_word[k]), int(first_word[k + 1])
        if not n_hit[k]:
            out.append((b - a, 0, [], [], text))
            continue
        turns = np.flatnonzero(np.diff(np.r_[False, hit[a:b], False].astype(np.int8))).tolist()
        spans = list(zip(turns[0::2], turns[1::2]))
        kept, at = [], 0
        for x, y in spans:
            kept.append(text[at : int(start[a + x] - offsets[k])])
            at = int(end[a + y - 1] - offsets[k])
        out.append((b - a, int(n_hit[k]), sorted(items.get(k, ())), spans, b"".join([*kept, text[at:]])))
    return out


def _searched(docs: DataFrame, benchmark: DataFrame, op: Decontamination, kept: list[str], text_col: str, item_col: str, item_text_col: str, cut: bool) -> DataFrame:
    """(row, clean, results): a struct of the columns ``kept``, the text without hit spans if ``cut``."""
    spark = docs.sparkSession
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length(item_text_col).cast("long")), F.lit(0))).first()[0]
    count = max(1, -(-size // op.block_bytes))
    dealt = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(item_text_col).alias("t"))
    blocks = []
    for k in range(count):
        part = dealt.where(F.pmod(F.xxhash64("i", "t"), F.lit(count)) == k).collect()  # about block_bytes
        blocks.append(spark.sparkContext.broadcast(windows([tuple(r) for r in part], op.window)))

    row = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(0).alias("none"))
    picked = docs.select(row.alias("row"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([picked.schema["row"], T.StructField("clean", T.StringType()), *RESULTS])
    span = pa.struct([("first", pa.int64()), ("end", pa.int64())])
    types = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(span)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _shards(batches, op.shard_bytes):
            *done, clean = zip(*_shard(texts, blocks, op))
            done[3] = [[{"first": a, "end": b} for a, b in x] for x in done[3]]
            columns = [pa.array(x, t) for x, t in zip(done, types)]
            cleaned = pa.array([x.decode() for x in clean], pa.string()) if cut else pa.nulls(len(texts), pa.string())
            yield pa.RecordBatch.from_arrays([rows, cleaned, *columns], [f.name for f in schema.fields])

    return picked.mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, op: Decontamination = Decontamination(), text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Every row of ``docs``, its columns but the text, with n_words, n_hit, items, spans.

    A window is ``op.window`` consecutive words of an item, or the whole of a shorter item. A
    word inside an occurrence of a window is hit. ``items``: sorted ids, as strings, of items with
    occurring windows; ``spans``: merged ranges [first, end) of hit words. Null text is empty and has
    no words; items with null or wordless text have no window; an item with a null id has windows
    but is not listed; repeated rows count each; empty tables give no hits or no rows. A very long
    text is a shard of its own. Windows are matched by 64-bit hashes of their words. Columns
    of ``docs`` may have any name; those called like a result are replaced.
    """
    kept = [c for c in docs.columns if c != text_col and c not in {f.name for f in RESULTS}]
    found = _searched(docs, benchmark, op, kept, text_col, item_col, item_text_col, cut=False)
    return found.select(*[F.col("row")[c].alias(c) for c in kept], *[f.name for f in RESULTS])


def decontaminated(docs: DataFrame, benchmark: DataFrame, op: Decontamination = Decontamination(), text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` with the hit spans of :func:`contamination` cut out of the text.

    The bytes between the words of a span go with it; a text without hits, null included, stays as it is.
    """
    found = _searched(docs, benchmark, op, docs.columns, text_col, item_col, item_text_col, cut=True)
    text = F.when(F.col("n_hit") > 0, F.col("clean")).otherwise(F.col("row")[text_col])
    return found.select(*[(text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """Whole documents, about ``size`` bytes of text at a time."""
    rows: list[pa.Array] = []
    texts: list[bytes] = []
    held = 0
    for batch in batches:
        own, at = texts_of(batch.column(1)), 0
        for k, text in enumerate(own):
            held += len(text) + 1
            if held >= size or k == len(own) - 1:
                rows.append(batch.column(0).slice(at, k + 1 - at))
                texts += own[at : k + 1]
                at = k + 1
                if held >= size:
                    yield pa.concat_arrays(rows), texts
                    rows, texts, held = [], [], 0
    if texts:
        yield pa.concat_arrays(rows), texts

