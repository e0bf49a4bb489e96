"""Document quality from a linear-chain conditional random field over lines.

Each line with a word is a node labelled good or bad. Its features, and those of the lines
before and after it, give the node scores; a 2 x 2 table scores neighbouring labels. Lines of a
labelled document train with the document's label. A document's quality is the mean of its
lines' forward-backward marginals of "good", weighted by their length in characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.llm.common import beside, mixed, texts_of, word_hashes

FEATURES = 11
_CODES = np.arange(256)
_SPACE = np.isin(_CODES, [9, 10, 11, 12, 13, 32])
_UPPER = (_CODES >= 65) & (_CODES <= 90)
_LETTER = _UPPER | (_CODES >= 97) & (_CODES <= 122) | (_CODES >= 128)
_DIGIT = (_CODES >= 48) & (_CODES <= 57)
_SYMBOL = ~_SPACE & ~_LETTER & ~_DIGIT & ~np.isin(_CODES, list(b".,;:'\"!?()-"))
_MARK = ~_SPACE & ~_LETTER & ~_DIGIT
_BAR = _CODES == 124


@dataclass(frozen=True)
class LineCRF:
    """``sample_docs``: at most so many labelled documents, the first by a hash of their id, are fitted."""

    sample_docs: int = 4000
    steps: int = 100
    l2: float = 1e-4
    threshold: float = 0.3
    batch_bytes: int = 500_000


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each line with a word, its characters, its text's number), lines in order."""
    blob = b"\n".join(texts) + b"\n"
    codes = np.frombuffer(blob, np.uint8)
    ends = np.flatnonzero(codes == 10)
    starts = np.r_[0, ends[:-1] + 1]
    doc = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]) - 1, ends)
    space = _SPACE[codes]
    begins = ~space & np.r_[True, space[:-1]]
    finals = ~space & np.r_[space[1:], True]

    def per_line(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, starts, dtype=np.int64)

    words = per_line(begins)
    chars = np.maximum(1, per_line(~space & ((codes & 0xC0) != 0x80)))
    letters = np.maximum(1, per_line(_LETTER[codes]))
    line = np.repeat(np.arange(len(ends)), words)
    hashes = word_hashes(blob)

    def variety(values: np.ndarray, of: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Share of distinct values in a line and of the commonest one."""
        with np.errstate(over="ignore"):
            _, first, count = np.unique(mixed(values + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True, return_counts=True)
        distinct, top = np.zeros(len(ends)), np.zeros(len(ends))
        np.add.at(distinct, of[first], 1)
        np.maximum.at(top, of[first], count)
        return distinct / np.maximum(1, total), top / np.maximum(1, total)

    distinct, top = variety(hashes, line, words)
    with np.errstate(over="ignore"):
        pairs = mixed(hashes[:-1] * np.uint64(3) + hashes[1:]) if len(hashes) > 1 else hashes[:0]
    same = line[1:] == line[:-1]
    new_pairs, _ = variety(pairs[same], line[1:][same], words - 1)
    new_pairs[words < 2] = 1
    with np.errstate(over="ignore"):
        sums = np.zeros(len(ends), np.uint64)
        np.add.at(sums, line, hashes)
        _, first = np.unique(mixed(sums + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    again = np.ones(len(ends))
    again[first] = 0
    out = np.stack(
        [
            per_line(_SYMBOL[codes]) / chars,
            per_line(_UPPER[codes]) / letters,
            per_line(_DIGIT[codes]) / chars,
            np.minimum(1, per_line(_BAR[codes]) / np.maximum(1, words)),
            distinct,
            top,
            new_pairs,
            np.log1p(words) / 5,
            np.minimum(3, chars / np.maximum(1, words) / 10),
            per_line(finals & _MARK[codes]) / np.maximum(1, words),
            again,
        ],
        axis=1,
    )
    full = words > 0
    return out[full].astype(np.float32), chars[full], doc[full]


def with_neighbours(x: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Features of a line, of the lines before and after in its text, two edge marks and a one."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    same = doc[1:] == doc[:-1]
    before[1:][same], after[:-1][same] = x[:-1][same], x[1:][same]
    first, last = np.r_[True, ~same][: len(x)], np.r_[~same, True][: len(x)]
    return np.column_stack([x, before, after, first, last, np.ones(len(x))]).astype(np.float64)


def forward_backward(score: np.ndarray, doc: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(marginal of label 1 for each line, expected counts of neighbouring labels).

    ``score`` is label 1's node score over label 0's. All chains advance together, so the
    loop runs over line places, not over lines.
    """
    n = len(score)
    cut = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[cut, n])
    order = np.argsort(-sizes, kind="stable")
    cut, sizes = cut[order], sizes[order]
    node = np.stack([np.zeros(n), score], axis=1)
    forward, backward = node.copy(), np.zeros((n, 2))

    def joined(x: np.ndarray) -> np.ndarray:
        high = x.max(axis=1, keepdims=True)
        return (high + np.log(np.exp(x - high).sum(axis=1, keepdims=True)))[:, 0]

    longest = int(sizes[0]) if n else 0
    active = [int(np.searchsorted(-sizes, -t)) for t in range(longest)]  # chains longer than t
    for t in range(1, longest):
        at = cut[: active[t]] + t
        for k in (0, 1):
            forward[at, k] += joined(forward[at - 1] + table[:, k])
    for t in range(longest - 2, -1, -1):
        at = cut[: active[t + 1]] + t
        after = node[at + 1] + backward[at + 1]
        for k in (0, 1):
            backward[at, k] = joined(table[k] + after)
    total = joined(forward + backward) if n else np.zeros(0)
    marginal = np.exp(forward[:, 1] + backward[:, 1] - total)
    expected = np.zeros((2, 2))
    at = np.flatnonzero(doc[1:] == doc[:-1])
    for j in (0, 1):
        for k in (0, 1):
            expected[j, k] = np.exp(forward[at, j] + table[j, k] + node[at + 1, k] + backward[at + 1, k] - total[at]).sum()
    return np.clip(marginal, 0, 1), expected


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    table: np.ndarray

    def quality(self, texts: list[bytes]) -> np.ndarray:
        """Score of each text; texts without a word get 0."""
        x, chars, doc = line_features(texts)
        good, _ = forward_backward(((with_neighbours(x, doc) - self.mean) / self.scale) @ self.weights, doc, self.table)
        return np.bincount(doc, good * chars, len(texts)) / np.maximum(1, np.bincount(doc, chars, len(texts)))


def fit(x: np.ndarray, doc: np.ndarray, label: np.ndarray, op: LineCRF) -> Model:
    """Maximum likelihood by Adam from a logistic start; ``label`` is each line's 0 or 1.

    Every text counts the same by its lines' share. One label only, or no line: a constant.
    """
    z = with_neighbours(x, doc)
    mean, scale = (z.mean(axis=0), z.std(axis=0)) if len(z) else (np.zeros(z.shape[1]), np.ones(z.shape[1]))
    mean[-1], scale = 0, np.where(scale > 1e-9, scale, 1)
    weights, table = np.zeros(z.shape[1]), np.zeros((2, 2))
    if len(z) == 0 or label.min() == label.max():
        weights[-1] = 4 * (2 * label[0] - 1) if len(z) else 0
        return Model(mean, scale, weights, table)
    z = (z - mean) / scale
    for _ in range(12):  # Newton steps of a ridge logistic fit
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        grad = z.T @ (label - p) / len(z) - op.l2 * weights
        weights += np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z / len(z) + op.l2 * np.eye(len(weights)), grad)
    at = np.flatnonzero(doc[1:] == doc[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[at], label[at + 1]), 1)
    state = np.zeros((2, len(weights) + 4))
    for step in range(1, op.steps + 1):
        good, expected = forward_backward(z @ weights, doc, table)
        grad = np.r_[z.T @ (label - good) / len(z) - op.l2 * weights, ((seen - expected) / len(z) - op.l2 * table).ravel()]
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.99 * state[1] + 0.01 * grad**2
        move = 0.05 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
        weights, table = weights + move[:-4], table + move[-4:].reshape(2, 2)
    return Model(mean, scale, weights, table)


def trained(docs: DataFrame, labels: DataFrame, op: LineCRF = LineCRF(), id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from ``labels`` (doc_id, quality) joined to ``docs``.

    Labels that are null are ignored; of several for a document the least counts. Lines are
    made into features where the texts are; only numbers of the bounded sample are collected.
    """
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # Ids are joined before the cut and texts after it, so the cut carries no text.
    chosen = ids.select("doc_id").join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(op.sample_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [line_features([t])[0].tobytes() for t in texts_of(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.int32()), pa.array(made, pa.binary())], ["doc_id", "quality", "x"])

    sample = ids.join(chosen, "doc_id").select("doc_id", "quality", "text").mapInArrow(run, "doc_id long, quality int, x binary")
    rows = sample.orderBy("doc_id").toPandas()
    parts = [np.frombuffer(x, np.float32).reshape(-1, FEATURES) for x in rows["x"]]
    sizes = [len(p) for p in parts]
    x = np.concatenate(parts) if parts else np.zeros((0, FEATURES), np.float32)
    return fit(x, np.repeat(np.arange(len(parts)), sizes), np.repeat(rows["quality"].to_numpy(), sizes).astype(np.int64), op)


def scored(docs: DataFrame, model: Model, op: LineCRF = LineCRF(), text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with score (0 to 1) and predicted (1 from the threshold on).

    Null, empty and blank texts score 0. Columns already called score or predicted are replaced.
    Whole texts are read; memory is bounded by batches of ``batch_bytes`` or one longer text.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    picked, names, fields = beside(docs, kept, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, scores, start, size = texts_of(batch.column(len(kept))), [], 0, 0
            for i, text in enumerate(texts):
                size += len(text)
                if size >= op.batch_bytes or i + 1 == len(texts):
                    scores.append(model.quality(texts[start : i + 1]))
                    start, size = i + 1, 0
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score), pa.array((score >= op.threshold).astype(np.int32))], [*names, "score", "predicted"])

    return picked.mapInArrow(run, ", ".join([*fields, "score double, predicted int"])).toDF(*kept, "score", "predicted")
