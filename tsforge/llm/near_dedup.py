"""Near-duplicate documents by MinHash signatures and a multi-index Hamming join.

A document is the set of its distinct ``shingle``-word runs. Its signature holds 2 x
``positions`` minima of as many hash permutations, cut to 16 bits. Two sets of Jaccard
similarity J differ in a position with probability 1 - J, so pairs at the threshold differ in
at most ``radius`` of the first ``positions`` entries but for a chance of about 2e-5.

The join finds *every* pair within ``radius``: the entries are split into so many chunks that,
by the pigeonhole principle, one chunk holds at most one error. Each document enumerates, for
each chunk, the chunk with any one entry left out; equal keys are exactly the pairs with at
most one error there. Pairs in a bucket are then kept by their signature distance, and links
are confirmed on the full sets. Equal sets are collapsed before, and large buckets are dealt
out as pairs of bounded blocks.

Links are found in two passes. The first only looks at the closest earlier row of each row in a
bucket; the second at all pairs that do not yet lie in one component. So a group of thousands
of close copies gives a link per row instead of all its pairs. A pair is taken up in one bucket
only, that of its first chunk with at most one error. Candidates are confirmed in groups of two
blocks of documents: a set travels once per group, not once per pair.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.llm.common import components, exchanges, grouped_batches, mixed, row_key, shingles, texts_of, written


@dataclass(frozen=True)
class NearDedup:
    """``threshold_pct`` is the least 100 * intersection / union of a link."""

    threshold_pct: int = 80
    shingle: int = 5
    positions: int = 64
    deviations: float = 4.2
    block_rows: int = 1024
    set_block: int = 512

    def distance(self, entries: int) -> int:
        """Differing entries that pairs at the threshold stay below."""
        p = 1 - self.threshold_pct / 100
        return min(entries - 1, math.ceil(entries * p + self.deviations * math.sqrt(entries * p * (1 - p))))

    @property
    def chunks(self) -> list[np.ndarray]:
        """Runs of entries; with one error allowed in each, 2 * len(chunks) > radius."""
        return np.array_split(np.arange(self.positions), self.distance(self.positions) // 2 + 1)


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_011)
    return rng.integers(0, 2**31, n).astype(np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32)


def _signatures(sets: list[np.ndarray], entries: int) -> np.ndarray:
    """(len(sets), entries) uint16; every set must be non-empty."""
    factors, shifts = _permutations(entries)
    out = np.empty((len(sets), entries), np.uint16)
    start = 0
    while start < len(sets):
        stop, size = start + 1, len(sets[start])
        while stop < len(sets) and size + len(sets[stop]) <= 65_536:
            size += len(sets[stop])
            stop += 1
        low = (np.concatenate(sets[start:stop]) >> np.uint64(32)).astype(np.uint32)
        offsets = np.cumsum([0, *(len(s) for s in sets[start : stop - 1])])
        buffer = np.empty_like(low)
        for k in range(entries):
            np.multiply(low, factors[k], out=buffer)
            np.add(buffer, shifts[k], out=buffer)
            least = np.minimum.reduceat(buffer, offsets)
            out[start:stop, k] = (least * np.uint32(2654435761)) >> np.uint32(16)
        start = stop
    return out


def fingerprints(docs: DataFrame, op: NearDedup, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """(doc_id, n_shingles, set_key, signature): the set's size, a 128-bit key, the signature.

    Null and word-less texts have size 0 and neither key nor signature. ``texts`` adds the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, op.shingle) for t in texts_of(batch.column(1))]
            full = [i for i, s in enumerate(sets) if len(s)]
            sig = _signatures([sets[i] for i in full], 2 * op.positions) if full else np.zeros((0, 0), np.uint16)
            keys: list = [None] * len(sets)
            sigs: list = [None] * len(sets)
            for row, i in enumerate(full):
                keys[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                sigs[i] = sig[row].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())] + [batch.column(1)] * texts,
                ["doc_id", "n_shingles", "set_key", "signature"] + ["text"] * texts,
            )

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, signature binary" + ", text string" * texts)


def _keys(reps: DataFrame, op: NearDedup) -> DataFrame:
    """(key, slot, rid): every chunk of a signature with each one of its entries left out.

    ``slot`` is the entry left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.random.default_rng(20_021).integers(1, 2**62, op.positions).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(len(ids), -1)[:, : op.positions]
            keys = np.empty((len(ids), op.positions), np.uint64)
            with np.errstate(over="ignore"):
                parts = mixed((sig.astype(np.uint64) + np.uint64(1)) * weights)
                for chunk in op.chunks:
                    whole = parts[:, chunk].sum(axis=1, dtype=np.uint64)
                    for left_out in chunk:
                        keys[:, left_out] = mixed(whole - parts[:, left_out] + weights[left_out])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.tile(np.arange(op.positions, dtype=np.int16), len(ids))), pa.array(np.repeat(ids, op.positions))],
                ["key", "slot", "rid"],
            )

    return reps.select("rid", "signature").mapInArrow(run, "key long, slot short, rid long")


def _buckets(keys: DataFrame, op: NearDedup) -> DataFrame:
    """(key, slot, i, j, p, rid): rows of keys that occur twice, dealt to pairs of bounded blocks.

    A bucket of n rows has ceil(n / block_rows) blocks, chosen by a hash; a row goes to every
    pair of blocks that holds its own, so each task group stays near 2 * block_rows rows.
    """
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = keys.join(sizes, "key").withColumn("blocks", F.ceil(F.col("n") / op.block_rows))
    rows = rows.withColumn("p", F.pmod(F.xxhash64("rid"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("o")
    spread = rows.select("key", "slot", "rid", "p", other)
    return spread.select("key", "slot", F.least("p", "o").alias("i"), F.greatest("p", "o").alias("j"), "p", "rid")


def _candidates(buckets: DataFrame, info: DataFrame, op: NearDedup, nearest: bool, blocks: int) -> DataFrame:
    """(x, y, pairs, rids): candidate pairs by the blocks of their documents.

    Pairs lie within the signature distances and the size ratio of the threshold. ``info`` has
    (rid, n_shingles, signature, component). ``nearest``: only the closest earlier row of each
    row in a bucket; otherwise all pairs from different components. ``pairs`` are packed ids.
    """
    near, far = op.distance(op.positions), op.distance(2 * op.positions)
    pct, chunks = op.threshold_pct, op.chunks
    starts = np.array([c[0] for c in chunks])
    chunk_of = np.repeat(np.arange(len(chunks)), [len(c) for c in chunks])

    def compare(table: pa.Table) -> np.ndarray:
        cols = {c: table.column(c).to_numpy() for c in ("key", "slot", "i", "j", "p", "rid", "n_shingles", "component")}
        sig = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(table.num_rows, -1)
        start = np.r_[True, (np.diff(cols["key"]) != 0) | (np.diff(cols["i"]) != 0) | (np.diff(cols["j"]) != 0)]
        group = np.cumsum(start)
        rid, n, p, comp, slot = cols["rid"], cols["n_shingles"], cols["p"], cols["component"], cols["slot"]
        cross = cols["i"] != cols["j"]
        best = np.full(len(rid), 2**15)
        who = np.full(len(rid), -1)
        found = [np.zeros((0, 2), np.int64)]
        for d in range(1, int(np.bincount(group).max())):
            x = np.flatnonzero(group[d:] == group[:-d]) + d
            y = x - d
            ok = (~cross[x] | (p[x] != p[y])) & (100 * np.minimum(n[x], n[y]) >= pct * np.maximum(n[x], n[y])) & (rid[x] != rid[y])
            if not nearest:
                ok &= comp[x] != comp[y]
            x, y = x[ok], y[ok]
            for part in range(0, len(x), 8192):
                u, v = x[part : part + 8192], y[part : part + 8192]
                differ = sig[u] != sig[v]
                errors = np.add.reduceat(differ[:, : op.positions], starts, axis=1, dtype=np.int64)
                first = errors.sum(axis=1)
                whole = first + differ[:, op.positions :].sum(axis=1)
                # The bucket of the first chunk with at most one error takes the pair up; when the
                # chunks are equal, that is the bucket that leaves out the chunk's first entry.
                chunk = np.argmax(errors <= 1, axis=1)
                mine = chunk_of[slot[u]] == chunk
                mine &= (errors[np.arange(len(u)), chunk] == 1) | (slot[u] == starts[chunk])
                hit = mine & (first <= near) & (whole <= far)
                u, v, whole = u[hit], v[hit], whole[hit]
                if nearest:
                    closer = whole < best[u]
                    best[u[closer]], who[u[closer]] = whole[closer], v[closer]
                else:
                    found.append(np.stack([rid[u], rid[v]], axis=1))
        if nearest:
            x = np.flatnonzero(who >= 0)
            found.append(np.stack([rid[x], rid[who[x]]], axis=1))
        return np.unique(np.sort(np.concatenate(found), axis=1), axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped_batches(batches, ["key", "i", "j"], rows=100_000):
            both = compare(table)
            block = (mixed(both.astype(np.uint64)) % np.uint64(blocks)).astype(np.int64)
            flip = block[:, 0] > block[:, 1]
            both[flip], block[flip] = both[flip][:, ::-1], block[flip][:, ::-1]
            order = np.lexsort((block[:, 1], block[:, 0]))
            both, block = both[order], block[order]
            cut = np.flatnonzero(np.r_[True, (np.diff(block, axis=0) != 0).any(axis=1)]) if len(both) else np.zeros(0, np.int64)
            parts = np.split(both, cut[1:]) if len(cut) else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block[cut, 0], pa.int64()),
                    pa.array(block[cut, 1], pa.int64()),
                    pa.array([x.tobytes() for x in parts], pa.binary()),
                    pa.array([np.unique(x) for x in parts], pa.list_(pa.int64())),
                ],
                ["x", "y", "pairs", "rids"],
            )

    joined = buckets.join(info, "rid").select("key", "slot", "i", "j", "p", "rid", "n_shingles", "component", "signature")
    dealt = joined.repartition(exchanges(buckets.sparkSession), "key", "i", "j").sortWithinPartitions("key", "i", "j", "rid")
    return dealt.mapInArrow(run, "x long, y long, pairs binary, rids array<long>")


def _confirmed(candidates: DataFrame, texts: DataFrame, op: NearDedup) -> DataFrame:
    """(a, b): the candidate pairs whose full shingle sets reach the threshold; ``texts`` has (rid, text)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingles(t, op.shingle).tobytes() for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["rid", "data"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped_batches(batches, ["x", "y"], rows=2_000):
            members, asked = {}, []
            for rid, data in zip(table.column("rid").to_pylist(), table.column("data")):
                if rid is None:
                    asked.append(np.frombuffer(data.as_buffer(), np.int64).reshape(-1, 2))
                else:
                    members[rid] = np.frombuffer(data.as_buffer(), np.uint64)
            pairs = np.unique(np.concatenate(asked), axis=0)
            links = [np.zeros((0, 2), np.int64)]
            for part in np.split(pairs, np.flatnonzero(np.diff(pairs[:, 0])) + 1):
                one = members[part[0, 0]]
                others = [members[b] for b in part[:, 1].tolist()]
                sizes = np.array([len(o) for o in others])
                many = np.concatenate(others)
                hits = one[np.minimum(np.searchsorted(one, many), len(one) - 1)] == many
                both = np.add.reduceat(hits, np.cumsum(sizes) - sizes, dtype=np.int64)
                links.append(part[100 * both >= op.threshold_pct * (len(one) + sizes - both)])
            out = np.concatenate(links)
            yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["a", "b"])

    lists = candidates.groupBy("x", "y").agg(F.array_distinct(F.flatten(F.collect_list("rids"))).alias("rids"))
    needed = lists.select("x", "y", F.explode("rids").alias("rid"))
    full = written(texts.join(needed.select("rid").distinct(), "rid", "left_semi").mapInArrow(sets, "rid long, data binary"), "sets")
    rows = needed.join(full, "rid").select("x", "y", "rid", "data")
    rows = rows.unionByName(candidates.select("x", "y", F.lit(None).cast("long").alias("rid"), F.col("pairs").alias("data")))
    dealt = rows.repartition(exchanges(texts.sparkSession), "x", "y").sortWithinPartitions("x", "y")
    return dealt.mapInArrow(check, "a long, b long").distinct()


def _members(docs: DataFrame, op: NearDedup, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, bool]:
    """Members, repeated ids, and whether there are any; rows with a null id are left out.

    Members are (doc_id, n_shingles, set_key, copies, component_id, kept), one row per id and set.
    A set goes by the least id that has it; where an id is the least of several sets, each
    of them goes by a number below 0 made from its key.
    """
    prints = written(fingerprints(docs, op, id_col, text_col), "prints").where("doc_id IS NOT NULL")
    repeated = written(prints.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "repeated")
    repeats = not repeated.isEmpty()
    texts = docs.select(F.col(id_col).cast("long").alias("rid"), F.col(text_col).alias("text"))
    classes = prints.where("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("least"))
    prints = prints.withColumn("copies", F.lit(1).cast("long"))
    if repeats:
        prints = written(prints.groupBy("doc_id", "n_shingles", "set_key").agg(F.first("signature").alias("signature"), F.count(F.lit(1)).alias("copies")), "prints")
        classes = written(classes, "classes")
        several = classes.groupBy("least").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        own = -1 - F.conv(F.substring(F.hex("set_key"), 1, 15), 16, 10).cast("long")
        classes = classes.join(several, "least", "left").select("set_key", "least", F.when(F.col("n") > 1, own).otherwise(F.col("least")).alias("rid"))
    else:
        classes = classes.withColumn("rid", F.col("least"))
    classes = written(classes, "classes")
    if repeats:
        reps = prints.join(classes.withColumnRenamed("least", "doc_id"), ["doc_id", "set_key"]).select("rid", "n_shingles", "signature")
        again = docs.join(repeated.withColumnRenamed("doc_id", "_id"), docs[id_col].cast("long") == F.col("_id"), "left_semi")
        again = fingerprints(again, op, id_col, text_col, texts=True).join(classes.withColumnRenamed("least", "doc_id"), ["doc_id", "set_key"])
        again = written(again.groupBy("rid").agg(F.min("text").alias("text")), "again")
        texts = texts.join(repeated.withColumnRenamed("doc_id", "rid"), "rid", "left_anti").unionByName(again)
    else:
        reps = prints.join(classes.select(F.col("rid").alias("doc_id")), "doc_id", "left_semi")
        reps = reps.select(F.col("doc_id").alias("rid"), "n_shingles", "signature")
    buckets = written(_buckets(_keys(reps, op), op), "buckets")
    info = reps.join(buckets.select("rid").distinct(), "rid", "left_semi")
    info = written(info, "info")
    blocks = info.count() // op.set_block + 1
    first = _candidates(buckets, info.withColumn("component", F.col("rid")), op, True, blocks)
    links = written(_confirmed(written(first, "pairs"), texts, op), "links")
    found = written(components(links), "components")
    named = info.join(found.withColumnRenamed("node", "rid"), "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    second = _candidates(buckets, named, op, False, blocks)
    more = written(_confirmed(written(second, "pairs"), texts, op), "links")
    # Links between components: what the first pass joined counts as one node.
    found = components(links.unionByName(more)).withColumnRenamed("node", "rid")
    # Empty sets have no key: a join would send them all to one task.
    sets, empty = prints.where("n_shingles > 0"), prints.where("n_shingles = 0")
    member = sets.select("doc_id", "n_shingles", "set_key", "copies").join(classes, "set_key")
    member = member.join(found, "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    kept = F.col("component_id") == F.col("doc_id")
    if repeats:
        names = classes.join(found, "rid", "left").groupBy(F.coalesce("component", "rid").alias("component"))
        member = member.join(names.agg(F.min(F.struct("least", "set_key")).alias("one")), "component").withColumn("component_id", F.col("one.least"))
        kept = kept & (F.col("set_key") == F.col("one.set_key"))
    else:
        member = member.withColumn("component_id", F.col("component"))
    member = member.select("doc_id", "n_shingles", "set_key", "copies", "component_id", kept.alias("kept"))
    empty = empty.select("doc_id", "n_shingles", "set_key", "copies", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return member.unionByName(empty), repeated, repeats


def near_components(docs: DataFrame, op: NearDedup = NearDedup(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``.

    component_id is the least id reachable over links; kept marks one row that has it. Rows of
    one id with equal sets are one document, of which at most one row is kept; with different
    sets they are different documents. Rows with a null id are linked with nothing:
    component_id null, kept true. Null, empty and word-less texts are linked with nothing;
    texts of fewer words than a shingle are one shingle; equal sets are linked. Other columns
    are ignored.
    """
    member, _, repeats = _members(docs, op, id_col, text_col)
    if repeats:
        member = member.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).withColumn("kept", F.col("kept") & (F.col("copy") == 1))
    unnamed = fingerprints(docs.where(F.col(id_col).isNull()), op, id_col, text_col).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return member.select("doc_id", "n_shingles", "component_id", "kept").unionByName(unnamed)


def keep_one(docs: DataFrame, op: NearDedup = NearDedup()) -> DataFrame:
    """The rows of ``docs`` whose document stands for its component; all columns stay.

    Of several rows of a kept document (one id, equal sets) the least text stays, then the row
    with the least digest. Rows with a null id all stay.
    """
    member, repeated, repeats = _members(docs, op, "doc_id", "text")
    kept, unnamed = member.where("kept"), docs.where("doc_id IS NULL")
    if not repeats:
        return docs.join(kept.select("doc_id"), "doc_id", "left_semi").unionByName(unnamed)
    once = docs.join(repeated, "doc_id", "left_anti").where("doc_id IS NOT NULL").join(kept.select("doc_id"), "doc_id", "left_semi")
    many = docs.join(repeated, "doc_id", "left_semi")
    stay = kept.join(repeated, "doc_id", "left_semi").select(F.col("doc_id").alias("_id"), F.col("set_key").alias("_set"))
    prints = fingerprints(many, op, texts=True).groupBy("doc_id", "set_key").agg(F.min("text").alias("_text"))
    stay = prints.join(stay, (F.col("doc_id") == F.col("_id")) & F.col("set_key").eqNullSafe(F.col("_set"))).select("_id", "_text")
    whole = many.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), row_key(docs).alias("_key"))
    whole = whole.groupBy("doc_id", "text").agg(F.min_by("_row", "_key").alias("_row"))
    whole = whole.join(stay, (F.col("doc_id") == F.col("_id")) & F.col("text").eqNullSafe(F.col("_text")), "left_semi").select("_row.*")
    return once.unionByName(whole).unionByName(unnamed)
