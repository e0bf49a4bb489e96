"""What the operators of this package share: scratch tables, word hashes, connected components."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again; survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table


def released(spark: SparkSession, *done: DataFrame) -> None:
    """Free the disk of finished steps: tables of :func:`written` that no later step reads, and shuffle files.

    Spark deletes shuffle files when the driver's JVM collects the plans that used them.
    """
    for table in done:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.written_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def beside(df: DataFrame, kept: list[str], source: str) -> tuple[DataFrame, list[str], list[str]]:
    """``kept`` columns under plain names and ``source`` last, for mapInArrow, which takes no dotted names.

    Also gives the plain names and the schema fields of the kept columns.
    """
    names = [f"c{i}" for i in range(len(kept))]
    picked = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names)], F.col(f"`{source}`").alias("source"))
    return picked, names, [f"{n} {picked.schema[n].dataType.simpleString()}" for n in names]


def row_key(docs: DataFrame) -> Column:
    """A digest of all columns of a row; null and empty differ."""
    parts = [F.md5(F.col(f"`{f.name}`")) if f.dataType.typeName() == "string" else F.md5(F.to_json(F.struct(F.col(f"`{f.name}`")))) for f in docs.schema]
    return F.md5(F.concat_ws("|", *[F.coalesce(part, F.lit("-")) for part in parts]))


def exchanges(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts_of(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def _random_table(seed: int, size: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BYTES = _random_table(11, 256)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MULTIPLIERS = _random_table(13, 64)
_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = 1 << (n - 1).bit_length()
        inverse = np.uint64(pow(int(_BASE), -1, 2**64))
        with np.errstate(over="ignore"):
            _POWERS = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _BASE, np.uint64)], dtype=np.uint64)
            _INVERSES = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, inverse, np.uint64)], dtype=np.uint64)
    return _POWERS, _INVERSES


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (multiply and xor-shift)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word ``[^\\x20\\x09-\\x0D]+`` of one text, in order."""
    codes = np.frombuffer(text, np.uint8)
    if not len(codes):
        return np.zeros(0, np.uint64)
    space = _SPACE[codes]
    edge = np.flatnonzero(np.diff(np.r_[True, space, True].astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    powers, inverses = _powers(len(codes) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_BYTES[codes] * powers[: len(codes)], out=sums[1:])
        return mixed((sums[end] - sums[start]) * inverses[start] + (end - start).astype(np.uint64))


def span_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span [start, end) of one piece of text, never 0; equal spans have equal hashes."""
    powers, inverses = _powers(len(codes) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_BYTES[codes] * powers[: len(codes)], out=sums[1:])
        found = mixed((sums[end] - sums[start]) * inverses[start] + (end - start).astype(np.uint64))
    return np.where(found == 0, np.uint64(1), found)


def word_spans(text: bytes, is_word: np.ndarray, piece: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(offset, codes, start, end) of pieces of a long text; ``is_word`` says of each byte value whether words hold it.

    A piece ends between words, so working memory follows ``piece`` (and the longest word), not the text.
    """
    at = 0
    while at < len(text):
        codes = np.frombuffer(text, np.uint8, min(piece, len(text) - at), at)
        inside = is_word[codes]
        stop = len(codes)
        if at + stop < len(text) and inside[-1]:
            breaks = np.flatnonzero(~inside)
            if not len(breaks):
                piece *= 2  # one word longer than a piece
                continue
            stop = int(breaks[-1]) + 1
        inside = inside[:stop]
        edge = np.flatnonzero(np.diff(np.r_[False, inside, False].astype(np.int8)))
        yield at, codes[:stop], edge[0::2], edge[1::2]
        at += stop


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of ``n`` words; of the whole sequence when it is shorter."""
    n = min(n, len(words))
    if n == 0:
        return words
    with np.errstate(over="ignore"):
        total = np.zeros(len(words) - n + 1, np.uint64)
        for i in range(n):
            total += words[i : len(words) - n + 1 + i] * _MULTIPLIERS[i]
    return mixed(total + np.uint64(n))


def shingles(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text after lower-casing A-Z."""
    return np.unique(gram_hashes(word_hashes(text.lower()), n))


def grouped_batches(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 20_000) -> Iterator[pa.Table]:
    """Tables of whole groups, from a partition sorted by ``keys``; a group is never cut."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held)
        last = np.ones(table.num_rows, bool)
        for k in keys:
            column = table.column(k).to_numpy()
            last &= column == column[-1]
        cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        if cut:
            yield table.slice(0, cut)
        held, count = table.slice(cut).combine_chunks().to_batches(), table.num_rows - cut
    if held:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the undirected graph of ``edges`` (a, b); component is its least node.

    Alternates the large-star and small-star steps: each round moves every node's links to
    the least node around it, so chains halve. Each round is a checkpointed table, and only
    one aggregated number per round reaches the driver. Empty edges give an empty result.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        now = written(small.where("a <> b").distinct(), "edges")
        total = tuple(now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())
        if total == seen:
            break
        seen = total
    stars = now.groupBy("a").agg(F.min("b").alias("b"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct().join(stars.select(F.col("a").alias("node")), "node", "left_anti")
    )
