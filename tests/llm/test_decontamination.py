"""The FM-index against plain search, decontamination against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsforge.llm.decontamination import Decontamination, contamination, decontaminated
from tsforge.llm.fm_index import Bits, FMIndex, Wavelet, suffix_array

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS, BENCH = "doc_id long, text string, n_hit string, row int", "item_id long, text string"


def tokens(text):
    return [(m[0], m.start(), m.end()) for m in WORD.finditer((text or "").translate(LOWER))]


def brute(text, items, width):
    found = tokens(text)
    ws = [w for w, _, _ in found]
    hit, ids = set(), set()
    for item, body in items:
        own = [w for w, _, _ in tokens(body)]
        span = min(width, len(own))
        for a in range(len(own) - span + 1 if own else 0):
            for p in range(len(ws) - span + 1):
                if ws[p : p + span] == own[a : a + span]:
                    hit |= set(range(p, p + span))
                    ids |= {str(item)} if item is not None else set()
    spans = [k for k in sorted(hit) if k - 1 not in hit]
    ends = [k + 1 for k in sorted(hit) if k + 1 not in hit]
    return len(ws), len(hit), sorted(ids), list(zip(spans, ends)), found


def cut(text, spans, found):
    out, at = "", 0
    for a, b in spans:
        out += text[at : found[a][1]]
        at = found[b - 1][2]
    return out + text[at:]


def test_ranks_and_wavelet_levels():
    rng = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 65, 500):
        bits = rng.random(n) < 0.4
        packed, every = Bits(bits), np.arange(n + 1)
        assert packed.rank(every).tolist() == [int(bits[:i].sum()) for i in every]
        assert packed.at(every[:-1]).tolist() == bits.tolist()
        for size in (1, 2, 3, 9):
            symbols = rng.integers(0, size, n)
            tree = Wavelet(symbols, size)
            for c in range(size):
                assert tree.rank(np.full(n + 1, c), every).tolist() == [int((symbols[:i] == c).sum()) for i in every]
            got, rank = tree.access(every[:-1])
            assert got.tolist() == symbols.tolist() and rank.tolist() == [int((symbols[:i] == symbols[i]).sum()) for i in range(n)]


@pytest.mark.parametrize("sample", [1, 3, 8])
def test_index_finds_every_occurrence(sample):
    rng = random.Random(sample)
    for _ in range(30):
        text = []
        for _ in range(rng.randint(1, 6)):
            text += [rng.randint(1, 3) for _ in range(rng.randint(1, 15))] + [0]
        order = suffix_array(np.array(text))
        assert sorted(order.tolist()) == list(range(len(text)))
        index = FMIndex(np.array(text), sample)
        phrases = [[0] * (5 - k) + [rng.randint(1, 3) for _ in range(k)] for k in rng.choices(range(1, 6), k=20)]
        low, high = index.search(np.array(phrases))
        for p, a, b in zip(phrases, low, high):
            p = [x for x in p if x]
            want = [i for i in range(len(text)) if text[i : i + len(p)] == p]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def rows():
    rng = random.Random(3)
    vocab = ["the", "of", "ünd", "Über", "x1", "7", "a-b", "naïve"]
    text = lambda n: "".join(rng.choice(vocab).upper() if rng.random() < 0.3 else rng.choice(vocab) + rng.choice([" ", ", ", "\n", "."]) for _ in range(n))
    items = [(k, text(rng.randint(3, 14))) for k in range(6)] + [(10, "rare"), (2, text(5)), (None, text(9)), (30, None), (31, " .,"), (9, "")]
    docs = [(k, text(rng.choice([0, 2, 9, 40, 90]))) for k in range(40)]
    docs += [(k, docs[5][1] + " " + items[k % 4][1] + "!" + items[2][1]) for k in range(50, 60)] + docs[:3] + [(None, items[1][1]), (70, None), (71, ""), (72, "RARE Rare."), (73, "x" * 5000 + " rare")]
    return docs, items


@pytest.mark.parametrize("op", [Decontamination(window=3), Decontamination(window=4, shard_bytes=1, sample=1), Decontamination(window=3, shard_bytes=700, block_bytes=60, sample=2)])
def test_contamination_equals_brute_force(spark, op):
    docs, items = rows()
    left = spark.createDataFrame([(i, t, "old", k) for k, (i, t) in enumerate(docs)], DOCS).withColumn("a.b", F.lit(1)).withColumn("clean", F.lit("c"))
    bench = spark.createDataFrame(items, BENCH)
    found = contamination(left, bench, op)
    got = {r.row: r for r in found.collect()}
    clean = {r.row: r.text for r in decontaminated(left, bench, op).collect()}
    assert len(got) == len(docs) == len(clean)
    for k, (i, t) in enumerate(docs):
        n, hits, ids, spans, where = brute(t, items, op.window)
        r = got[k]
        assert (r.doc_id, r.n_words, r.n_hit, r["items"]) == (i, n, hits, ids)
        assert [tuple(s) for s in r.spans] == spans and r["a.b"] == 1 and r.clean == "c"
        assert clean[k] == (cut(t, spans, where) if hits else t)


def test_nothing_to_search_or_to_find(spark):
    docs, items = rows()
    left = spark.createDataFrame([(i, t, "", 0) for i, t in docs], DOCS)
    bench = spark.createDataFrame(items, BENCH)
    for nothing in (bench.where("false"), bench.where("text is null"), bench.where("item_id = 31")):
        assert {(r.n_hit, tuple(r["items"])) for r in contamination(left, nothing).collect()} == {(0, ())}
        assert sorted(map(str, (r.text for r in decontaminated(left, nothing).collect()))) == sorted(str(t) for _, t in docs)
    assert contamination(left.where("false"), bench).collect() == []
