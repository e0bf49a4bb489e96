"""Range minima and the prefix trie against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsforge.llm.prefix_trie import PrefixTrie, RangeMinimum, prefix_trie

TURNS = "conv_id long, turn long, role string, text string"


def brute(turns):
    """{(smallest member, depth): row} of all nodes."""
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    convs = {}
    for c, turn, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            convs.setdefault(c, []).append((turn is not None, turn or 0, md5(md5(role) + ":" + md5(text)), role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in convs.items()}
    seqs = {}
    for c in own:
        h, head = zlib.crc32(str(c).encode()) % 9, c - int(np.fmod(c, 5))
        seqs[c] = own.get(head, [])[:h] + own[c][h:]
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    out = []
    for p, ids in members.items():
        sub = [q for q in members if q[: len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in sub if q)
        leaves = [q for q in sub if not any(len(x) == len(q) + 1 and x[:-1] == q for x in sub)]
        ends = ",".join(str(c) for c in sorted(ids) if len(seqs[c]) == len(p))
        out.append((min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), sum(len(q) == len(p) + 1 for q in sub), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda x: (x[1], x[0]))


def conversations(seed):
    rng = random.Random(seed)
    turns = []
    for c in [*range(-7, 60), 10**12, 10**12 + 3]:
        n = rng.choice([1, 2, 3, 9, 12])
        turns += [(c, k, rng.choice(["user", "bot"]), rng.choice(["hi", "a", "Grüße", "x" * 40])) for k in range(n)]
    for c in range(60, 90):  # one very common conversation
        turns += [(c, k, "user", f"common {k}") for k in range(12)]
    turns += [(200, k, "user", f"long {k}") for k in range(90)] + [(203, k, "user", f"long {k}") for k in range(70)]
    turns += [(300, None, None, None), (300, None, "", ""), (300, 1, "user", None), (300, 1, "bot", "tie"), (300, 1, "bot", "tie"), (None, 0, "user", "nobody")]
    rng.shuffle(turns)
    return turns


def test_range_minima_and_reaches():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 17, 64):
        values = rng.integers(0, 4, n)
        table = RangeMinimum(values)
        pairs = [(a, b) for a in range(n) for b in range(a + 1, n + 1)]
        low, high = np.array(pairs).T
        assert table.over(low, high).tolist() == [int(values[a:b].min()) for a, b in pairs]
        for row in range(n):
            for depth in range(5):
                right = max(b for b in range(row, n) if (values[row + 1 : b + 1] >= depth).all())
                left = min(a for a in range(row + 1) if (values[a + 1 : row + 1] >= depth).all())
                assert table.reach_right(np.array([row]), np.array([depth])).tolist() == [right]
                assert table.reach_left(np.array([row]), np.array([depth])).tolist() == [left]


@pytest.mark.parametrize("op", [PrefixTrie(), PrefixTrie(block_rows=1, id_bucket=7), PrefixTrie(block_rows=3), PrefixTrie(block_bytes=2000, id_bucket=3)])
def test_trie_equals_brute_force(spark, op):
    turns = conversations(op.block_rows % 10)
    rows = spark.createDataFrame(turns, TURNS).withColumn("seq", F.lit(1)).withColumn("own", F.lit("x"))
    got = prefix_trie(rows, op)
    assert sorted((tuple(r) for r in got.collect()), key=lambda x: (x[1], x[0])) == brute(turns)


def test_trie_of_little(spark):
    for turns in ([], [(None, 1, "user", "x")], [(5, 0, "user", "one")], [(c, 0, "user", "x") for c in range(30)]):
        got = prefix_trie(spark.createDataFrame(turns, TURNS))
        assert sorted((tuple(r) for r in got.collect()), key=lambda x: (x[1], x[0])) == brute(turns)
