"""Word sequences that stand together more often than their parts, per language.

Every word is the lead of one window of four: its own and the next three words of its piece, padded
at the end of the piece. Only these longest windows are counted; ROLLUP over (language, word 1, ...,
word 4) sums them to shorter and shorter prefixes, which are the counts of all phrases of one to
four words, and of all words of a language.

Most windows of a corpus are rare. A first pass counts words, pairs and triples in hashed buckets; a
window ends before its first pair or triple, or is empty before its first word, whose bucket stays below
the support. A bucket holds at least the count of what falls into it, so no frequent phrase is
touched, and all words still count in the total. The buckets follow the size of the texts up to
2**30, a bit each for the second pass (128 MB); in still larger corpora the filter lets more
through, and the exact counts take the load.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsforge.llm.common import exchanges, mixed, span_hashes, texts_of, word_spans, written

WIDTH = 4
COLUMNS = [f"w{i}" for i in range(1, WIDTH + 1)]
IS_BREAK = np.zeros(256, bool)
IS_BREAK[[*b".,;:!?\n\x0b\x0c\r"]] = True
IS_WORD = ~IS_BREAK
IS_WORD[[0x20, 0x09]] = False
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
RANGE_BITS = 8


@dataclass(frozen=True)
class Collocations:
    support: int = 30
    covered_pct: int = 80
    top: int = 2000
    shard_bytes: int = 8 << 20


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, bytes]]:
    """(language, lower-cased texts one to a line), about ``size`` bytes of text at a time, a document never cut."""
    held: dict[str, list[bytes]] = {}
    count = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
            held.setdefault(lang, []).append(text)
            count += len(text) + 1
            if count >= size:
                yield from ((k, b"\n".join(v).lower()) for k, v in held.items())
                held, count = {}, 0
    yield from ((k, b"\n".join(v).lower()) for k, v in held.items())


def _words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, number of the piece, first and end byte of each word."""
    parts, pieces = [(np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)], 0
    for at, codes, start, end in word_spans(text, IS_WORD):
        breaks = np.cumsum(IS_BREAK[codes])
        parts.append((span_hashes(codes, start, end), breaks[start] + pieces, start + at, end + at))
        pieces += int(breaks[-1])
    return tuple(np.concatenate(x) for x in zip(*parts))


def _buckets(lang: str, words: np.ndarray, pieces: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For words, pairs and triples: where one begins, and the bucket of each that does."""
    out, total = [], np.zeros(len(words), np.uint64)
    with np.errstate(over="ignore"):
        for size in (1, 2, 3):
            n = len(words) - size + 1
            if n <= 0:
                out.append((np.zeros(0, np.int64), np.zeros(0, np.uint64)))
                continue
            total = total[:n] + words[size - 1 :] * _ODD[size - 1]
            begins = np.flatnonzero(pieces[:n] == pieces[size - 1 :])
            salt = np.uint64(int.from_bytes(hashlib.md5(f"{size}{lang}".encode()).digest()[:8], "little"))
            out.append((begins, mixed(total[begins] ^ salt) >> np.uint64(64 - bits)))
    return out


def gaps_packed(values: np.ndarray) -> bytes:
    """Rising whole numbers as bytes of their gaps; each 255 adds to the next byte."""
    more, rest = np.divmod(np.diff(values, prepend=0), 255)
    out = np.full(len(values) + int(more.sum()), 255, np.uint8)
    out[np.cumsum(more + 1) - 1] = rest
    return out.tobytes()


def gaps_unpacked(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps < 255]


def _sketch(texts: DataFrame, op: Collocations, bits: int) -> np.ndarray:
    """A bit for each bucket: whether at least ``support`` words, pairs and triples fall into it."""
    low = bits - RANGE_BITS
    enough = min(op.support, 255)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 1)
        for lang, text in _shards(batches, op.shard_bytes):
            words, pieces, _, _ = _words(text)
            found, times = np.unique(np.concatenate([b for _, b in _buckets(lang, words, pieces, bits)]), return_counts=True)
            edges = np.searchsorted(found, np.arange((1 << RANGE_BITS) + 1, dtype=np.uint64) << np.uint64(low))
            rows = []
            for part in np.flatnonzero(np.diff(edges)):
                own = slice(edges[part], edges[part + 1])
                places, counts = gaps_packed((found[own] & np.uint64((1 << low) - 1)).astype(np.int64)), np.minimum(times[own], 255).astype(np.uint8).tobytes()
                rows.append((int(part), len(places), codec.compress(places + counts, asbytes=True), len(places) + len(counts)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.int64()))], ["part", "places", "data", "size"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        now, total = None, None
        done = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(total >= enough, bitorder="little").tobytes()], pa.binary())], ["part", "bits"])
        for batch in batches:
            for part, places, data, size in zip(*(c.to_pylist() for c in batch.columns)):
                if part != now:
                    if now is not None:
                        yield done()
                    now, total = part, np.zeros(1 << low, np.uint8)
                raw = codec.decompress(data, size, asbytes=True)
                at = gaps_unpacked(raw[:places])
                total[at] = np.minimum(total[at].astype(np.uint16) + np.frombuffer(raw, np.uint8, offset=places), 255)
        if now is not None:
            yield done()

    counted = texts.mapInArrow(count, "part int, places long, data binary, size long")
    dealt = counted.repartition(exchanges(texts.sparkSession), "part").sortWithinPartitions("part")
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in dealt.mapInArrow(add, "part int, bits binary").toLocalIterator():  # 2**bits bits in all
        out[row.part << (low - 3) : (row.part + 1) << (low - 3)] = np.frombuffer(row.bits, np.uint8)
    return out


def _distinct(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of four small numbers, and how often each occurs."""
    size = int(columns.max(initial=0)) + 1
    left, right = columns[0] * size + columns[1], columns[2] * size + columns[3]
    order = np.lexsort([right, left])
    left, right = left[order], right[order]
    new = np.flatnonzero(np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])]) if len(left) else np.zeros(0, np.int64)
    return columns[:, order[new]], np.diff(np.r_[new, len(left)])


def _leads(lang: str, text: bytes, bits: int, often_bits: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct words of a shard (hash, first and end byte), and for each place the numbers from 1 of its window's words."""
    words, pieces, start, end = _words(text)
    often = np.zeros((3, len(words)), bool)
    for row, (begins, bucket) in zip(often, _buckets(lang, words, pieces, bits)):
        row[begins] = (often_bits[(bucket >> np.uint64(3)).astype(np.int64)] >> (bucket & np.uint64(7)).astype(np.uint8)) & 1 == 1
    vocab, first, code = np.unique(words, return_index=True, return_inverse=True)
    lead = np.zeros((WIDTH, len(words)), np.int64)
    open_at = often[0]
    lead[0] = np.where(open_at, code + 1, 0)
    for k in range(1, min(WIDTH, len(words))):  # word k joins if its pair, and from the third word on its triple, may be frequent
        reaches = np.zeros(len(words), bool)
        reaches[:-k] = often[1][k - 1 : -1] & (often[2][k - 2 : -2] if k > 1 else True)
        open_at = open_at & reaches
        lead[k, :-k] = np.where(open_at[:-k], code[k:] + 1, 0)
    return vocab, start[first], end[first], lead


def _windows(texts: DataFrame, op: Collocations, bits: int, shared) -> DataFrame:
    """(lang, w1, ..., w4, n): counted windows of word hashes, padded with 0."""
    names = ["lang", *COLUMNS, "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, text in _shards(batches, op.shard_bytes):
            vocab, _, _, lead = _leads(lang, text, bits, shared.value)
            rows, times = _distinct(lead)
            hashes = np.r_[np.uint64(0), vocab].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(times), pa.string()), *[pa.array(hashes[c]) for c in rows], pa.array(times, pa.int64())], names)

    return texts.mapInArrow(run, "lang string, " + ", ".join(f"{c} long" for c in COLUMNS) + ", n long").groupBy("lang", *COLUMNS).agg(F.sum("n").alias("n"))


def _spelled(texts: DataFrame, op: Collocations, bits: int, shared) -> DataFrame:
    """(h, word): the text of every word that stands in a window of two words or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, text in _shards(batches, op.shard_bytes):
            vocab, start, end, lead = _leads(lang, text, bits, shared.value)
            used = np.zeros(len(vocab) + 1, bool)
            used[lead[1:].ravel()] = used[lead[0][lead[1] > 0]] = True
            used = np.flatnonzero(used[1:])
            spans = zip(start[used].tolist(), end[used].tolist())
            yield pa.RecordBatch.from_arrays([pa.array(vocab[used].view(np.int64)), pa.array([text[a:b].decode() for a, b in spans], pa.string())], ["h", "word"])

    return texts.mapInArrow(run, "h long, word string")


def _part(size: int, start: int, stop: int) -> list:
    """The columns of words start..stop-1 of a phrase, moved to the front and padded."""
    return [F.col(COLUMNS[start + i]) if start + i < stop <= size else F.lit(0).cast("long") for i in range(WIDTH)]


def collocations(docs: DataFrame, op: Collocations = Collocations(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``op.top`` phrases.

    A phrase has two to four words of one piece (no break ``[.,;:!?\\x0A-\\x0D]`` between them) and
    occurs a >= ``support`` times, overlaps included, after lower-casing A-Z. Of its cuts into two parts that occur l
    and r times, the one with the least floor(2000000 * a / (l + r)) counts, ties to the shortest
    first part. A phrase inside a longer one of at least ``covered_pct`` % of its occurrences is
    left out. n: all words of the language. Order: score, then a, falling, then the phrase by bytes.
    Null text is empty, null language is ``und``; repeated rows count each; a table without
    frequent phrases gives no rows; other columns play no part. Words are told apart by 64-bit hashes.
    """
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    bits = min(30, max(16, (size // 8).bit_length()))
    shared = texts.sparkSession.sparkContext.broadcast(_sketch(texts, op, bits))
    found = written(_windows(texts, op, bits, shared), "windows")

    counted = found.rollup("lang", *COLUMNS).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    words = F.when(F.col("level") == 0, 4).when(F.col("level") == 1, 3).when(F.col("level") == 3, 2).when(F.col("level") == 7, 1).when(F.col("level") == 15, 0)
    counted = counted.select("lang", *[F.coalesce(c, F.lit(0)).alias(c) for c in COLUMNS], "f", words.alias("size"))
    full = F.col("size") == 0  # the row of the whole language
    for k, c in enumerate(COLUMNS, 1):
        full = full | (F.col("size") == k) & (F.col(c) != 0) & (F.col("f") >= op.support)
    counted = written(counted.where(full), "phrases")
    totals, frequent, longer = counted.where("size = 0").select("lang", F.col("f").alias("n")), counted.where("size > 0"), counted.where("size > 2")

    def parts(rows: DataFrame, spans: list[tuple[int, int, int]]) -> DataFrame:
        """One row for each part of each phrase: spans are (size, first word, end)."""
        made = F.array(*[F.when(F.col("size") == k, F.struct(*[x.alias(f"p{i}") for i, x in enumerate(_part(k, a, b), 1)], F.lit(a).alias("at"), F.lit(b).alias("to"))) for k, a, b in spans])
        return rows.select("*", F.explode(F.filter(made, lambda x: x.isNotNull())).alias("part")).select("*", "part.*").drop("part")

    same = ["lang", *[f"p{i}" for i in range(1, WIDTH + 1)]]
    by_part = frequent.select("lang", *[F.col(c).alias(f"p{i}") for i, c in enumerate(COLUMNS, 1)], F.col("f").alias("g"))
    cuts = [(k, a, b) for k in range(2, WIDTH + 1) for j in range(1, k) for a, b in ((0, j), (j, k))]
    candidate = ["lang", *COLUMNS, "size", "f"]
    halves = parts(frequent.where("size > 1"), cuts).join(by_part, same)
    cut = F.when(F.col("at") == 0, F.col("to")).otherwise(F.col("at"))
    halves = halves.groupBy(*candidate, cut.alias("k")).agg(F.max(F.when(F.col("at") == 0, F.col("g"))).alias("l"), F.max(F.when(F.col("at") > 0, F.col("g"))).alias("r"))
    score = F.expr("(2000000 * cast(f as decimal(20,0))) div (cast(l as decimal(20,0)) + r)")
    scored = halves.groupBy(*candidate).agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")).select(*candidate, "best.score", "best.l", "best.r")

    inside = [(k, a, b) for k in range(3, WIDTH + 1) for a in range(k) for b in range(a + 2, k + 1) if b - a < k]
    cover = parts(longer, inside).groupBy(*same).agg(F.max("f").alias("over"))
    cover = cover.select("lang", *[F.col(f"p{i}").alias(c) for i, c in enumerate(COLUMNS, 1)], "over")
    covered = F.expr(f"100 * cast(over as decimal(20,0)) >= {op.covered_pct} * cast(f as decimal(20,0))")
    kept = scored.join(cover, ["lang", *COLUMNS], "left").where(~F.coalesce(covered, F.lit(False)))

    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("f"))
    first = kept.withColumn("rank", F.rank().over(best)).where(F.col("rank") <= op.top)  # with all ties of the last
    first = written(first.select(*candidate, "score", "l", "r"), "first")
    places = first.select("lang", *COLUMNS, F.posexplode(F.array(*COLUMNS)).alias("at", "h")).where("h != 0")
    wanted = written(places.select("h").distinct(), "words")
    spelled = _spelled(texts, op, bits, shared).join(wanted, "h", "left_semi").groupBy("h").agg(F.min("word").alias("word"))
    places = places.join(spelled, "h")
    phrases = places.groupBy("lang", *COLUMNS).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    rows = first.join(phrases, ["lang", *COLUMNS]).join(totals, "lang")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("f"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= op.top)
    return rows.select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score")
