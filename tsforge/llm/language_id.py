"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. An n-gram's vector binds (multiplies) its
letters' vectors, each permuted (rotated) by its place; a text's vector bundles (adds) the
vectors of all its n-grams. A language's prototype bundles its training texts. A text gets the
language whose prototype has the largest cosine with the text's vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsforge.llm.common import beside

UNKNOWN = "und"
_PLACE = 1 << 21  # more than the number of code points


@dataclass(frozen=True)
class Hyper:
    dimensions: int = 1024
    gram: int = 3
    seed: int = 17
    batch_docs: int = 128
    batch_chars: int = 1 << 21


class _Letters:
    """Random vectors by code point, made when first met."""

    def __init__(self, op: Hyper):
        self.op, self.known = op, {}

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        if len(self.known) > 20_000:
            self.known.clear()
        rows = []
        for c in codes.tolist():
            if c not in self.known:
                bits = np.random.default_rng((self.op.seed, c)).integers(0, 2, self.op.dimensions, dtype=np.int8)
                self.known[c] = 2 * bits - 1
            rows.append(self.known[c])
        return np.array(rows, np.int8)


def grams(text: str, n: int) -> np.ndarray:
    """Codes of the letter n-grams of a text: lower case, other runs as one boundary."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32).astype(np.int64)
    if not len(codes):
        return codes
    distinct, back = np.unique(codes, return_inverse=True)
    letter = np.array([chr(c).isalpha() for c in distinct.tolist()])[back]
    if not letter.any():
        return codes[:0]
    codes = np.r_[0, np.where(letter, codes, 0), 0]
    keep = (codes != 0) | np.r_[True, codes[:-1] != 0]
    codes = codes[keep]
    if len(codes) < n:
        codes = np.r_[codes, np.zeros(n - len(codes), np.int64)]
    out = codes[: len(codes) - n + 1].copy()
    for i in range(1, n):
        out = out * _PLACE + codes[i : len(codes) - n + 1 + i]
    return out


def gram_vectors(codes: np.ndarray, letters: _Letters) -> np.ndarray:
    """Bound vectors of n-gram codes, one row each."""
    op = letters.op
    out = np.ones((len(codes), op.dimensions), np.int8)
    rest = codes.copy()
    for place in range(op.gram):  # from the last letter to the first
        distinct, back = np.unique(rest % _PLACE, return_inverse=True)
        out *= np.roll(letters(distinct), place, axis=1)[back]
        rest //= _PLACE
    return out


class _Counts:
    """How often each text has each n-gram: entries (text, place among the distinct codes, weight), sorted by code."""

    def __init__(self, texts: list[str | None], n: int):
        found = [np.unique(grams(t or "", n), return_counts=True) for t in texts]
        text = np.repeat(np.arange(len(texts)), [len(c) for c, _ in found])
        code = np.concatenate([c for c, _ in found])
        order = np.argsort(code, kind="stable")
        self.texts, self.text = len(texts), text[order]
        self.codes, self.at = np.unique(code[order], return_inverse=True)
        self.weight = np.concatenate([k for _, k in found])[order].astype(np.float32)

    def bundled(self, letters: _Letters, rows: np.ndarray | None = None, step: int = 8192) -> np.ndarray:
        """Sums of weighted n-gram vectors per text, or per ``rows[text]``; a step of n-grams at a time."""
        row = self.text if rows is None else rows[self.text]
        count = self.texts if rows is None else int(rows.max(initial=-1)) + 1
        out = np.zeros((count, letters.op.dimensions))
        for i in range(0, len(self.codes), step):
            low, high = np.searchsorted(self.at, (i, i + step))
            part = np.zeros((count, min(step, len(self.codes) - i)), np.float32)
            np.add.at(part, (row[low:high], self.at[low:high] - i), self.weight[low:high])
            out += part @ gram_vectors(self.codes[i : i + step], letters).astype(np.float32)
        return out


def _parts(batch: pa.RecordBatch, column: int, op: Hyper) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Stretches of a batch with their texts: at most ``batch_docs`` rows, and ``batch_chars`` or one longer text."""
    start, size, texts = 0, 0, []
    for row in range(batch.num_rows):
        texts.append(batch.column(column)[row].as_py())
        size += len(texts[-1] or "")
        if size >= op.batch_chars or len(texts) == op.batch_docs or row + 1 == batch.num_rows:
            yield batch.slice(start, len(texts)), texts
            start, size, texts = row + 1, 0, []


def prototypes(docs: DataFrame, op: Hyper = Hyper(), text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and their unit prototypes (languages x dimensions), from every row with a language.

    Sums are kept per language and dimension, so what reaches the driver is languages x
    dimensions numbers. Texts without letters add nothing. No rows: no languages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sums = _Letters(op), {}
        for whole in batches:
            for batch, texts in _parts(whole, 0, op):
                counts = _Counts(texts, op.gram)
                names, back = np.unique(np.array(batch.column(1).to_pylist()), return_inverse=True)
                # Each text weighs the same, however long it is.
                counts.weight /= np.sqrt(np.bincount(counts.text, counts.weight**2, counts.texts))[counts.text]
                for name, vector in zip(names.tolist(), counts.bundled(letters, back)):
                    sums[name] = sums.get(name, 0) + vector
        for name, vector in sums.items():
            # Fixed-point sums do not depend on the order of the tasks.
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * op.dimensions), pa.array(np.arange(op.dimensions, dtype=np.int32)), pa.array(np.rint(vector * 2**16).astype(np.int64))],
                ["lang", "d", "v"],
            )

    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).alias("t"), F.col(lang_col).alias("l"))
    sums = rows.mapInArrow(run, "lang string, d int, v long").groupBy("lang", "d").agg(F.sum("v").alias("v")).toPandas()
    langs = sorted(set(sums["lang"]))
    out = np.zeros((len(langs), op.dimensions))
    out[[langs.index(x) for x in sums["lang"]], sums["d"]] = sums["v"]
    return langs, out / np.maximum(1e-12, np.linalg.norm(out, axis=1, keepdims=True))


def identified(docs: DataFrame, langs: list[str], profile: np.ndarray, op: Hyper = Hyper(), text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (the cosine, at least 0); the text column is not kept.

    Null texts, texts without a letter, and any text when no language is known, are ``und``
    with score 0. Equal cosines go to the first language by name. Columns already called
    lang_pred or score are replaced.
    """
    kept = [c for c in docs.columns if c not in (text_col, "lang_pred", "score")]
    picked, plain, fields = beside(docs, kept, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _Letters(op)
        for whole in batches:
            for batch, texts in _parts(whole, len(kept), op):
                names, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
                counts = _Counts(texts, op.gram)
                if langs and len(counts.codes):
                    vectors = counts.bundled(letters)
                    cosine = vectors @ profile.T / np.maximum(1e-12, np.linalg.norm(vectors, axis=1, keepdims=True))
                    best = cosine.argmax(axis=1)
                    for i in np.unique(counts.text).tolist():
                        names[i], scores[i] = langs[best[i]], min(1.0, max(0.0, cosine[i, best[i]]))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores)], [*plain, "lang_pred", "score"])

    return picked.mapInArrow(run, ", ".join([*fields, "lang_pred string, score double"])).toDF(*kept, "lang_pred", "score")


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(id_col).cast("string")) % folds
