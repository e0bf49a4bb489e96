"""Byte-level BPE encoding in linear time by backtracking, and decoding.

A token sequence is what the merges give exactly when every two neighbours are: the pair's
joined bytes encode to that pair again. The encoder walks a piece from left to right, takes
the longest token that starts there and is compatible with the token before, tries the next
shorter prefix token otherwise, and steps back when none is left; positions known to fail are
marked, so no position is tried twice. Matches come from an Aho-Corasick automaton over the
bytes read as Latin-1. Pair answers are memoised.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.llm.common import beside

CACHED_PIECES = 150_000
LONGEST_CACHED = 48
CACHED_PAIRS = 250_000
BATCH_BYTES = 4_000_000
BATCH_ROWS = 1024


class BytePairs:
    """Encoder and decoder for one rank file; every id is its token's merge rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split = regex.compile(pattern).findall
        self.at_spaces = pattern == public_tokenizers.PATTERN
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.sizes = {i: len(t) for t, i in ranks.items()}
        self.packs = {i: i.to_bytes(4, "little") for i in self.tokens}
        self.shorter: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in sorted(ranks.items(), key=lambda x: x[1]):
            self.automaton.add_word(token.decode("latin-1"), i)
            cut = next((n for n in range(len(token) - 1, 0, -1) if token[:n] in ranks), 0)
            if cut:
                self.shorter[i] = ranks[token[:cut]]
            parts = self._last_merge(token, i)
            if parts:
                self.halves[i] = parts
                self.joined[parts] = i
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens that stand before ``token`` is merged, from merges of lower rank."""
        parts = [token[k : k + 1] for k in range(len(token))]
        while len(parts) > 2:
            found = [(r, k) for k in range(len(parts) - 1) if (r := self.ranks.get(parts[k] + parts[k + 1], rank)) < rank]
            if not found:
                return None
            _, k = min(found)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None

    def compatible(self, left: int, right: int) -> bool:
        """Whether the bytes of both tokens encode to these two tokens.

        Undoes merges in falling rank on the two sides of the seam; a merge across the seam
        that would have come before the one just undone breaks the pair.
        """
        known = self.pairs.get((left, right))
        if known is not None:
            return known
        a, b, before, good = left, right, len(self.ranks) + 1, True
        while True:
            across = self.joined.get((a, b))
            if across is not None and across < before:
                good = False
                break
            # The side merged last is undone first; at one rank the left of two equal tokens is older.
            undo_left = a > b
            if (a if undo_left else b) not in self.halves:
                undo_left = not undo_left
            if (a if undo_left else b) not in self.halves:
                break
            if undo_left:
                before, a = a, self.halves[a][1]
            else:
                before, b = b + 1, self.halves[b][0]
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        self.pairs[left, right] = good
        return good

    def _longest(self, piece: bytes) -> Callable[[int], int]:
        """Gives the longest token that starts at a position of ``piece``."""
        letters = piece.decode("latin-1")
        if len(piece) <= LONGEST_CACHED:
            # Every byte is a token, so the leftmost longest match starts at the position asked for.
            ask = self.automaton.iter_long
            return lambda at: next(ask(letters, at))[1]
        # A call costs time in proportion to the piece: long ones get all answers in one walk.
        # Matches come by rising end, so the last one of a start is its longest.
        found = [0] * len(piece)
        for end, i in self.automaton.iter(letters):
            found[end + 1 - self.sizes[i]] = i
        return found.__getitem__

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size, at, last = len(piece), 0, None
        longest_at = self._longest(piece)
        sizes, shorter, pairs = self.sizes, self.shorter, self.pairs
        dead = bytearray(size + 1)
        out: list[int] = []
        token = longest_at(0)
        while at < size:
            while token is not None:
                end = at + sizes[token]
                if not dead[end]:
                    if last is None:
                        break
                    good = pairs.get((last, token))
                    if good or good is None and self.compatible(last, token):
                        break
                token = shorter.get(token)
            if token is not None:
                out.append(token)
                at, last = end, token
                token = longest_at(at) if at < size else None
            else:
                dead[at] = 1
                token = out.pop()
                at -= sizes[token]
                token, last = shorter.get(token), out[-1] if out else None
        return out

    def _packed(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = b"".join([self.packs[i] for i in self.encode_piece(piece.encode())])
            if len(piece) <= LONGEST_CACHED:
                if len(self.pieces) >= CACHED_PIECES:
                    self.pieces.clear()
                self.pieces[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers.

        With the standard pattern a single space between two other characters that are not
        white space always starts a match, so the parts between such spaces are cached whole;
        a text with other spaces is matched as it is.
        """
        if not self.at_spaces:
            return b"".join(map(self._packed, self.split(text)))
        known, parts = self.parts, text.split(" ")
        first = parts[0]
        if not first or first[-1].isspace():
            return b"".join(map(self._packed, self.split(text)))
        head = b"".join(map(self._packed, self.split(first)))
        try:
            return head + b"".join([known[p] for p in parts[1:]])
        except KeyError:
            pass
        out = [head]
        for part in parts[1:]:
            ids = known.get(part)
            if ids is None:
                if not part or part[0].isspace() or part[-1].isspace():
                    return b"".join(map(self._packed, self.split(text)))
                ids = b"".join(map(self._packed, self.split(" " + part)))
                if len(part) <= LONGEST_CACHED:
                    if len(known) >= CACHED_PIECES:
                        known.clear()
                    known[part] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> BytePairs:
    """The coder of a rank file, once per Python worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)}
    return BytePairs(ranks, pattern)


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _mapped(df: DataFrame, source: str, outs: list[str], make: Callable[[bytes], tuple[bytes, ...]]) -> DataFrame:
    """All columns of ``df`` and binary columns ``outs`` = make(value of ``source``), in batches of bounded bytes."""
    kept = [c for c in df.columns if c not in outs]
    picked, names, fields = beside(df, kept, source)
    made_names = [f"made{i}" for i in range(len(outs))]

    def answered(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        start, size, made = 0, 0, [[] for _ in outs]
        column = batch.column(len(kept)).cast(pa.large_binary())
        for row in range(batch.num_rows):
            value = column[row].as_py() or b""
            results = make(value)
            for held, result in zip(made, results):
                held.append(result)
            size += len(value) + sum(map(len, results))
            if size >= BATCH_BYTES or row + 1 == batch.num_rows:
                part = batch.slice(start, row + 1 - start)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *[pa.array(m, pa.binary()) for m in made]], [*names, *made_names])
                start, size, made = row + 1, 0, [[] for _ in outs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                yield from answered(whole.slice(at, BATCH_ROWS))
            pa.default_memory_pool().release_unused()

    return picked.mapInArrow(run, ", ".join([*fields, *[f"{m} binary" for m in made_names]])).toDF(*kept, *outs)


def encoded(df: DataFrame, text_col: str = "text", out: str = "ids", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``df`` with the packed ids of each whole text (little-endian unsigned 32-bit).

    Null and empty texts give no ids (an empty binary, not null). A column already called
    ``out`` is replaced; all others stay. Each match of ``pattern`` is encoded separately.
    """
    path = path or default_path()
    return _mapped(df, text_col, [out], lambda text: (load(path, pattern).encode(text.decode()),))


def decoded(df: DataFrame, ids_col: str = "ids", out: str = "decoded", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``df`` with the bytes of packed ids; null gives empty bytes."""
    path = path or default_path()
    return _mapped(df, ids_col, [out], lambda ids: (load(path, pattern).decode(ids),))


def round_trip(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """All columns of ``docs`` with ids, the bytes they decode to, and n_tokens.

    Both steps run in one worker, which holds one set of tables.
    """
    path = path or default_path()

    def both(text: bytes) -> tuple[bytes, bytes]:
        coder = load(path, pattern)
        ids = coder.encode(text.decode())
        return ids, coder.decode(ids)

    return _mapped(docs, "text", ["ids", "decoded"], both).withColumn("n_tokens", (F.length("ids") / 4).cast("long"))
