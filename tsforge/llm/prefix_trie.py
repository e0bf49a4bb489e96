"""The trie of conversation prefixes, from sorted sequences and range minima of their shared lengths.

Every turn is a digest, every conversation the string of its digests; equal conversations
collapse before anything is sorted. The distinct sequences are range-sorted, and each task reads its
rows in blocks. In a block a sparse table holds the minima of the shared lengths of neighbours over
powers of two; a prefix of a row reaches left and right as far as those minima stay at its
length, which two binary searches find independently for all prefixes at once. Sums over a
prefix's members are differences of running sums.

A prefix that reaches an end of its block may go on in the next one. Such open prefixes, those of a
block's first and last row only, are put together by their digest; whatever else a block finds is
final. Nothing is gathered in one place, and a prefix that a third of all rows share costs one open row a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsforge.llm.common import exchanges, written

HEX = 32  # characters of a digest
NO_ENDS = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class PrefixTrie:
    block_rows: int = 50_000
    block_bytes: int = 32 << 20
    id_bucket: int = 65_536


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, seq): turns as (digest, bytes), each conversation after the first turns of its group's head.

    Turns stand by number, null first, equal ones by digest; null role or text is empty. The first
    h = crc32(conv_id) % 9 turns are those of conversation conv_id - conv_id % 5, as many as it
    has, and the conversation's own turns follow from its h-th on. Rows with a null conv_id
    belong to no conversation and are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat_ws(":", F.md5(role), F.md5(text)))
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").alias("turn"), digest.alias("digest"), F.octet_length(text).alias("bytes")).alias("t"))
    own = rows.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("t")), lambda x: F.struct(x["digest"].alias("digest"), x["bytes"].alias("bytes"))).alias("own"))
    own = written(own, "conversations")
    heads = own.where("conv_id % 5 = 0").select(F.col("conv_id").alias("head"), F.slice("own", 1, 8).alias("first"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    both = own.join(heads, F.col("conv_id") - F.col("conv_id") % 5 == F.col("head"), "left")
    start = F.coalesce(F.slice("first", F.lit(1), h), F.slice("own", 1, 0))
    return both.select("conv_id", F.concat(start, F.slice("own", h + 1, F.greatest(F.lit(0), F.size("own") - h))).alias("seq"))


def sequences(convs: DataFrame, op: PrefixTrie) -> DataFrame:
    """(seq, bytes, ids, first_id, members): equal conversations in runs of neighbouring ids, ids joined in order."""
    rows = convs.select("conv_id", F.array_join(F.transform("seq", lambda x: x["digest"]), "").alias("seq"), F.transform("seq", lambda x: x["bytes"]).alias("bytes"))
    rows = rows.groupBy("seq", F.floor(F.col("conv_id") / F.lit(op.id_bucket)).alias("bucket")).agg(F.array_sort(F.collect_list("conv_id")).alias("all"), F.first("bytes").alias("bytes"))
    return rows.select("seq", "bytes", "bucket", F.array_join(F.transform("all", lambda x: x.cast("string")), ",").alias("ids"), F.element_at("all", 1).alias("first_id"), F.size("all").cast("long").alias("members"))


class RangeMinimum:
    """Minima of any stretch of an array, from tables of minima over powers of two."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def over(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum of [low, high), each at least one long."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), self.levels[0].dtype)
        for k in np.unique(level):
            own = level == k
            out[own] = np.minimum(self.levels[k][low[own]], self.levels[k][high[own] - (1 << k)])
        return out

    def reach_right(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last row up to which all values after ``row`` are at least ``depth``, by halving steps."""
        at = row.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            table = self.levels[k]
            fits = at + 1 + (1 << k) <= len(self.levels[0])
            ok = fits & (table[np.where(fits, at + 1, 0)] >= depth)
            at[ok] += 1 << k
        return at

    def reach_left(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first row from which all values up to that of ``row`` are at least ``depth``."""
        at = row.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            table = self.levels[k]
            fits = at - (1 << k) >= 0
            ok = fits & (table[np.where(fits, at + 1 - (1 << k), 0)] >= depth)
            at[ok] -= 1 << k
        return at


def _ramps(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """start, start + 1, ... for each range, and the number of the range."""
    owner = np.repeat(np.arange(len(size)), size)
    return np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + start[owner], owner


def shared_lengths(seqs: list[str]) -> np.ndarray:
    """How many digests each sequence shares with the one before; -1 for the first, which shares no root here."""
    out = np.full(len(seqs), -1, np.int64)
    for i in range(1, len(seqs)):
        a, b = seqs[i - 1], seqs[i]
        low, high = 0, min(len(a), len(b)) // HEX
        if a[: HEX * high] == b[: HEX * high]:
            low = high
        while low < high:
            middle = (low + high + 1) // 2
            if a[: HEX * middle] == b[: HEX * middle]:
                low = middle
            else:
                high = middle - 1
        out[i] = low
    return out


def block_nodes(seqs: list[str], sizes: list[list[int]], first: np.ndarray, members: np.ndarray, ends: list[str], name: str) -> dict:
    """All prefixes of a block of sorted distinct sequences, as columns.

    ``row`` names the border row of an open prefix and is null for a final one. An open prefix
    has the sums over its final descendants here; ``parent`` is the digest of an open parent,
    whose smallest member is not known yet.
    """
    n = len(seqs)
    length = np.array([len(s) // HEX for s in seqs])
    lcp = shared_lengths(seqs)
    table, least = RangeMinimum(lcp), RangeMinimum(first)
    base = np.cumsum(length + 1) - (length + 1)
    upto = np.concatenate([np.r_[0, np.cumsum(s, dtype=np.int64)] for s in sizes])  # bytes of the first d turns of row i, at base[i] + d
    running = lambda values: np.concatenate([[0], np.cumsum(values)])

    depth, row = _ramps(lcp + 1, length - lcp)  # each prefix once, at the first row that has it
    at = np.cumsum(length - lcp) - (length - lcp)
    inner, shallower = depth > 0, np.maximum(depth - 1, 0)
    left, right = table.reach_left(row, depth), table.reach_right(row, depth)
    parent_left, parent_right = table.reach_left(row, shallower), table.reach_right(row, shallower)
    parent = at[parent_left] + shallower - (lcp[parent_left] + 1)  # its place among the prefixes
    is_open = (left == 0) | (right == n - 1)
    final = ~is_open

    count, weight = running(members), running(members * upto[base + length])
    n_convs = count[right + 1] - count[left]
    n_children = np.bincount(parent[final & inner], minlength=len(depth))
    leaves = running(np.bincount(row[final & (n_children == 0)], minlength=n))
    above = np.where(inner, upto[base[row] + shallower], 0)
    own = upto[base[row] + depth] - above
    distinct = running(np.bincount(row[final], weights=own[final], minlength=n).astype(np.int64))
    # The sum from row ``left`` on also holds the final prefixes there that are shorter than this one.
    longest_open = np.maximum(np.maximum.reduceat(np.where(is_open, depth, -1), at), lcp)
    shorter = np.where(final, above - upto[base[row] + np.maximum(longest_open[row], 0)], 0)
    saved = weight[right + 1] - weight[left] - n_convs * above - (distinct[right + 1] - distinct[left] - shorter)

    node = [hashlib.md5(seqs[r][: HEX * d].encode()).hexdigest() if o else None for r, d, o in zip(row.tolist(), depth.tolist(), is_open.tolist())]
    open_parent = (inner & is_open[parent]).tolist()
    out = {
        "conv_id": least.over(left, right + 1).tolist(),
        "depth": depth.tolist(),
        "parent_conv_id": [v if d and not o else None for v, d, o in zip(least.over(parent_left, parent_right + 1).tolist(), depth.tolist(), open_parent)],
        "n_convs": n_convs.tolist(),
        "n_children": n_children.tolist(),
        "n_leaves": (leaves[right + 1] - leaves[left]).tolist(),
        "saved": saved.tolist(),
        "ends": [ends[r] if d == k else None for r, d, k in zip(row.tolist(), depth.tolist(), length[row].tolist())],
        "node": node,
        "parent": [node[p] if o else None for p, o in zip(parent.tolist(), open_parent)],
        "bytes": own.tolist(),
        "row": [(f"{name}.first" if r == 0 else f"{name}.last") if o else None for r, o in zip(row.tolist(), is_open.tolist())],
    }
    if n > 1:  # the last row's open prefixes that the first row has too, without sums: the way up from its own
        for d in range(int(lcp[1:].min()) + 1):
            extra = {"depth": d, "n_convs": 0, "n_children": 0, "n_leaves": 0, "saved": 0, "node": hashlib.md5(seqs[-1][: HEX * d].encode()).hexdigest(), "row": f"{name}.last"}
            for k, column in out.items():
                column.append(extra.get(k))
    return out


PIECES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, ends string, node string, parent string, bytes long, row string"


def _pieces(rows: DataFrame, op: PrefixTrie) -> DataFrame:
    """The prefixes of all blocks of range-sorted sequences."""
    kinds = [pa.string() if part.split()[1] == "string" else pa.int64() for part in PIECES.split(", ")]
    names = [part.split()[0] for part in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seqs: list[str] = []
        sizes, first, members, ends = [], [], [], []
        held, number = 0, 0

        def block() -> pa.RecordBatch:
            found = block_nodes(seqs, sizes, np.array(first), np.array(members), [e.hexdigest() for e in ends], f"{TaskContext.get().partitionId()}.{number}")
            return pa.RecordBatch.from_arrays([pa.array(found[k], t) for k, t in zip(names, kinds)], names)

        for batch in batches:
            for seq, size, ids, least, count in zip(*(batch.column(c).to_pylist() for c in ("seq", "bytes", "ids", "first_id", "members"))):
                if seqs and seq == seqs[-1]:  # the next run of ids of the same sequence
                    ends[-1].update(("," + ids).encode())
                    members[-1] += count
                    continue
                if len(seqs) >= op.block_rows or held >= op.block_bytes:
                    yield block()
                    seqs, sizes, first, members, ends, held, number = [], [], [], [], [], 0, number + 1
                seqs.append(seq)
                sizes.append(size)
                first.append(least)
                members.append(count)
                ends.append(hashlib.sha256(ids.encode()))
                held += len(seq)
        if seqs:
            yield block()

    spread = rows.repartitionByRange(exchanges(rows.sparkSession), "seq").sortWithinPartitions("seq", "bucket")
    return spread.mapInArrow(run, PIECES)


def prefix_trie(turns: DataFrame, op: PrefixTrie = PrefixTrie(), convs: DataFrame | None = None) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations: see :func:`rebuilt`, or give ``convs`` yourself.

    conv_id: the smallest member; depth; parent_conv_id: that of the prefix one turn shorter, null for
    the root; n_convs: members; n_children; n_leaves: childless prefixes in its subtree, itself included;
    saved_tokens: over its subtree, bytes of the last turn times members less one; ends_sha256: SHA-256 of
    the ids, rising and joined by commas, of members that end here. A conversation without turns
    ends at the root; without conversations there is no row. A conversation is one row of 36
    bytes a turn; equal turns are told by MD5 of role and text.
    """
    rows = written(sequences(rebuilt(turns) if convs is None else convs, op), "sequences")
    pieces = written(_pieces(rows, op), "prefixes")
    parts = pieces.where("row is not null")
    whole = parts.groupBy("depth", "node").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved").alias("saved"), F.max("ends").alias("ends"), F.max("parent").alias("parent"), F.max("bytes").alias("bytes"), F.min(F.when(F.col("conv_id").isNotNull(), F.col("row"))).alias("owner"),
    )
    children = whole.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("open_children"))
    whole = written(whole.join(children, "node", "left").fillna(0, ["open_children"]), "open")
    # Each open prefix counts once, on the path of one border row, for itself and all above it.
    mine = F.col("row") == F.col("owner")
    leaf = F.col("n_children") + F.col("open_children") == 0
    paths = parts.select("row", "node").distinct().join(whole.select("node", "depth", "owner", "bytes", leaf.alias("leaf")), "node")
    up = Window.partitionBy("row").orderBy(F.desc("depth"))
    paths = paths.select("node", F.sum(F.when(mine, F.col("bytes")).otherwise(0)).over(up).alias("below"), F.sum((mine & F.col("leaf")).cast("long")).over(up).alias("tips"))
    below = paths.groupBy("node").agg(F.sum("below").alias("below"), F.sum("tips").alias("tips"))
    least = written(whole.select(F.col("node").alias("parent"), F.col("conv_id").alias("open_parent")), "open-parents")
    upper = whole.join(below, "node").select(
        "conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", (F.col("n_children") + F.col("open_children")).alias("n_children"),
        (F.col("n_leaves") + F.col("tips")).alias("n_leaves"), (F.col("saved") - F.col("below")).alias("saved"), "ends", "parent",
    )
    rest = pieces.where("row is null").select(*upper.columns).unionByName(upper)
    known = rest.where("parent is null").drop("parent")
    joined = rest.where("parent is not null").join(least, "parent").withColumn("parent_conv_id", F.col("open_parent")).select(*known.columns)
    rest = known.unionByName(joined)
    return rest.select(*known.columns[:6], F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))
