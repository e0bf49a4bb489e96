"""Phrase counts and their order against plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsforge.llm.collocations import Collocations, collocations, gaps_packed, gaps_unpacked

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "text string, lang string, rank int"


def brute(data, op):
    out = []
    for lang in {x or "und" for _, x in data}:
        f, n = Counter(), 0
        for text, own in data:
            if (own or "und") != lang:
                continue
            for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
                ws = re.findall("[^ \t]+", piece)
                n += len(ws)
                f.update(tuple(ws[i : i + k]) for k in range(1, 5) for i in range(len(ws) - k + 1))
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= op.support}
        rows = []
        for p, a in found.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(100 * b >= op.covered_pct * a for q, b in found.items() if len(q) > len(p) and inside(q)):
                continue
            score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((" ".join(p), a, l, r, n, score))
        rows.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, i, *x) for i, x in enumerate(rows[: op.top], 1)]
    return sorted(out)


def test_gaps_go_there_and_back():
    rng = np.random.default_rng(2)
    for values in ([], [0], [0, 1, 254, 255, 256, 511, 70_000], np.unique(rng.integers(0, 10**6, 300))):
        assert gaps_unpacked(gaps_packed(np.array(values, np.int64))).tolist() == list(values)


@pytest.mark.parametrize("op", [Collocations(support=4), Collocations(support=3, shard_bytes=1, top=7, covered_pct=60), Collocations(support=300)])
def test_phrases_equal_brute_force(spark, op):
    rng = random.Random(8)
    vocab = ["a", "B", "über", "Ünd", "d-e", "x y", "(f)", "g"]
    sep = [" ", " ", " ", "  ", "\t", ", ", "\n", ".", "? ", "\r\n"]
    data = [("".join(rng.choice(vocab) + rng.choice(sep) for _ in range(rng.choice([0, 1, 3, 30]))), rng.choice(["en", "de", None])) for _ in range(60)]
    data += [("one two three four five. " * 6, "en")] * 3 + [(None, "en"), ("", "fr"), ("...", None), ("New New New New New", "fr"), ("w" * 3000 + " end", "en")] + data[:9]
    docs = spark.createDataFrame([(t, x, 1) for t, x in data], DOCS).withColumn("a.b", F.lit(0)).withColumn("w1", F.lit(0))
    got = collocations(docs, op)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(data, op)


def test_no_documents_no_phrases(spark):
    assert collocations(spark.createDataFrame([], DOCS)).collect() == []
