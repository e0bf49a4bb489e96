"""Near-dedup, line dedup, repeated passages, mixing and BPE against plain Python."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from brute import dedup_lines as brute_lines
from brute import mix as brute_mix
from brute import near_components as brute_components
from brute import repeated_words, shingle_set, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tsforge.llm import byte_bpe, line_dedup
from tsforge.llm.common import components, gram_hashes, word_hashes
from tsforge.llm.line_dedup import LineDedup, dedup_lines
from tsforge.llm.mixing import Curriculum, mixed_documents, placed, scheduled
from tsforge.llm.near_dedup import NearDedup, keep_one, near_components
from tsforge.llm.repeated_passages import Repeats, repeated_passages

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows(seed, count, vocabulary=400, sizes=(20, 140)):
    """Random texts with exact copies, near copies, shared passages, blanks, nulls and a long text."""
    rng = random.Random(seed)
    w = [f"w{i}" for i in range(vocabulary)]
    line = lambda n: " ".join(rng.choice(w) for _ in range(n))
    texts = ["\n".join(line(rng.randint(3, 14)) for _ in range(rng.randint(*sizes) // 8)) for _ in range(count)]
    base = line(90)
    for k in range(count // 3):
        copy = base.split()
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = rng.choice(w)
        texts.append(" ".join(copy))
    passage = line(55)
    texts += [line(5) + " " + passage + "\n" + line(9) for _ in range(4)] + [texts[0], texts[0], texts[1].upper()]
    texts += [None, "", "  \n\t", "one", "one", "a b c", line(30_000), "Ä ß\n\nÄ ß"]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts))


def frame(spark, data):
    return spark.createDataFrame([(i, t, "en", f"s{i % 4}" if i % 5 else None, len(t or "")) for i, t in data], DOCS)


@pytest.mark.parametrize("pct,block", [(85, 1024), (80, 7)])
def test_near_components_equal_brute_force(spark, pct, block):
    data = rows(1, 40)
    docs = frame(spark, data).withColumn("rid", F.lit("clash")).withColumn("component", F.lit(None).cast("int"))
    got = {r.doc_id: r for r in near_components(docs, NearDedup(threshold_pct=pct, block_rows=block, set_block=5)).collect()}
    want = brute_components(data, pct)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_near_dedup_of_nothing_and_keep_one(spark):
    empty = spark.createDataFrame([], DOCS)
    assert near_components(empty).collect() == []
    data = [(3, "a b c d e f g"), (1, "A b c d e F g"), (7, None), (9, None), (4, "")]
    kept = keep_one(frame(spark, data))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 7, 9] and kept.columns[:2] == ["doc_id", "text"]


def test_signature_distance_keeps_pairs_at_the_threshold():
    for pct in (80, 85, 90):
        op = NearDedup(threshold_pct=pct)
        assert 2 * len(op.chunks) > op.distance(op.positions) and sum(map(len, op.chunks)) == op.positions


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(101, 100), (102, 101), (102, 102)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components(edges.where("a < 0")).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab \t\nÄ\x0b\x1c\x85"), max_size=40))
def test_word_hashes_follow_the_word_pattern(text):
    w, h = words(text), word_hashes(text.encode())
    assert len(w) == len(h) and len(set(w)) == len(set(h.tolist()))
    assert len(shingle_set(text)) == len(np.unique(gram_hashes(word_hashes(text.lower().encode()), 5))) or not text.isascii()


@pytest.mark.parametrize("salt_rows", [100_000, 20])
def test_line_dedup_equals_brute_force(spark, salt_rows):
    data = rows(2, 40, vocabulary=60)
    docs = frame(spark, data).withColumn("line_no", F.lit("clash"))
    done = dedup_lines(docs, LineDedup(salt_rows=salt_rows))
    assert done.columns == docs.columns
    got = done.collect()
    assert {r.doc_id: r.text for r in got} == brute_lines(data)
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) for r in got)


def test_line_dedup_pairs_of_near_copies_stay_linear(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    copies = [" ".join(base)]
    for k in range(200):
        places = rng.sample(range(60), 3)
        copies.append(" ".join(f"replaced{k}x{i}" if i in places else w for i, w in enumerate(base)))
    data = list(enumerate(copies))
    sizes, plain = [], line_dedup.written

    def counted(df, name):
        table = plain(df, name)
        sizes.extend([table.count()] if name == "pairs" else [])
        return table

    monkeypatch.setattr(line_dedup, "written", counted)
    assert {r.doc_id: r.text for r in dedup_lines(frame(spark, data)).collect()} == brute_lines(data)
    assert sum(sizes) <= 8 * len(data)


def test_lines_that_share_rare_words_only_meet_in_no_group(spark):
    """Two words in all lines, the longest ones, make no group of them; lines over the threshold show a common link."""
    rng = random.Random(6)
    long = ["w" * 40, "v" * 40]
    lines = [long + [f"a{rng.randrange(10**6)}" for _ in range(38)] for _ in range(60)]
    near = [[f"b{i}" if i in places else w for i, w in enumerate(line)] for line in lines for places in [rng.sample(range(2, 40), 4)]]
    data = spark.createDataFrame([(k, 0, w) for k, w in enumerate(lines + near)], "doc_id long, line_no int, words array<string>")
    shown = {r.doc_id: set(r.links) for r in line_dedup.first_lines(line_dedup.token_sets(data, "doc_id", "line_no"), LineDedup()).collect()}
    assert all(shown[k] & shown[60 + k] for k in range(60))
    assert sum(bool(shown[a] & shown[b]) for a in range(60) for b in range(a)) < 60 * 59 / 20


def test_line_dedup_special_rows(spark):
    docs = frame(spark, [(2, "x y\n\nx y"), (1, "x y")]).unionByName(spark.createDataFrame([(None, "x y", None, None, 3)], DOCS))
    got = {r.doc_id: r.text for r in dedup_lines(docs).collect()}
    assert got == {1: "x y", 2: "", None: "x y"}
    assert dedup_lines(spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("chunk", [20_000, 3])
def test_repeated_passages_equal_brute_force(spark, chunk):
    data = rows(3, 30, vocabulary=3000)
    rng = random.Random(5)
    shared = [f"p{rng.randrange(900)}" for _ in range(130)]
    for k in range(12):  # passages of several lengths, one inside another, at text borders too
        cut = shared[rng.randrange(30) : 80 + rng.randrange(50)]
        data.append((1000 + k, " ".join([f"l{k}"] * rng.randrange(3) + cut + [f"r{k}"] * rng.randrange(3))))
    data.append((2000, " ".join(["same"] * 300)))  # repeats itself only
    got = {}
    for r in repeated_passages(frame(spark, data).withColumn("h", F.lit("clash")), Repeats(chunk_rows=chunk)).collect():
        assert r.end_word - r.start_word >= 50 and r.other_doc_id != r.doc_id
        got.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    assert got == repeated_words(data, 50)


def test_repeated_passages_of_nothing(spark):
    assert repeated_passages(spark.createDataFrame([], DOCS)).collect() == []


def test_mix_equals_brute_force(spark):
    data = [(i, t, f"s{i % 4}" if i % 5 else None) for i, t in rows(4, 30) if t is None or len(t) < 5000]
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in data], DOCS).withColumn("slice", F.lit(1)).withColumn("rank", F.lit(1))
    for op in (Curriculum(), Curriculum(slice_rows=3)):
        got = {r.doc_id: (r.size, r.source_size, r.target, r.taken) for r in placed(docs, op).collect()}
        want = brute_mix(data)
        assert {i: g[:2] + g[3:] for i, g in got.items()} == {i: w[:2] + w[3:] for i, w in want.items()}
        assert all(abs(got[i][2] - want[i][2]) < 1e-6 for i in want)
    spots = placed(docs)
    passes = scheduled(spots).collect()
    assert sum(r.pass_words for r in passes) == sum(r.taken for r in spots.collect())
    assert all(0 <= r.position <= 1 for r in passes) and all(r.taken <= 3 * r.size for r in spots.collect())
    order = [(r.position, r.doc_id, r.epoch) for r in passes]
    assert order == sorted(order)
    texts = {i: t for i, t, _ in data}
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    got = sorted((r.doc_id, r.text) for r in out.collect())  # whole documents, the border ones by the nearer side
    assert got == sorted((r.doc_id, texts[r.doc_id]) for r in passes if 2 * r.pass_words >= r.size)
    clash = docs.withColumns({c: F.lit(7) for c in ("size", "position", "epoch", "pass_words", "_key", "key", "row", "a.b")})
    out = mixed_documents(clash)
    assert out.columns == clash.columns and sorted((r.doc_id, r.text) for r in out.collect()) == got
    assert set(out.select("_key", "position", "`a.b`").collect()) == {(7, 7, 7)}


def test_curriculum_position_inverts_the_integral():
    op = Curriculum()
    for knots in op.schedules:
        t = np.linspace(0, 1, 2001)
        density = np.interp(t, np.linspace(0, 1, len(knots)), knots)
        assert (density >= 0).all() and np.trapezoid(density, t) > 0


def test_mix_without_words_or_rows(spark):
    docs = spark.createDataFrame([(1, None, "en", "a", 0), (2, "", "en", None, 0)], DOCS)
    assert [(r.size, r.target, r.taken) for r in placed(docs).collect()] == [(0, 0.0, 0)] * 2
    assert mixed_documents(docs).collect() == [] and placed(docs.where("doc_id < 0")).collect() == []


@pytest.fixture(scope="module")
def coders():
    own = byte_bpe.load(byte_bpe.default_path(), public_tokenizers.PATTERN)
    return own, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet=st.sampled_from("abcdethrsing \n\t'.,0123é"), max_size=120)))
def test_bpe_equals_tiktoken(coders, text):
    own, other = coders
    ids = own.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == other.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


def test_bpe_long_pieces_and_tables(spark, coders):
    own, other = coders
    long = "ab" * 20_000 + " " + "é" * 500
    data = [(1, long), (2, None), (3, ""), (3, ""), (4, "  two  spaces \n\n x ")]
    docs = frame(spark, data).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1))
    for r in byte_bpe.round_trip(docs).collect():
        text = dict(data)[r.doc_id] or ""
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == other.encode_ordinary(text)
        assert bytes(r.decoded).decode() == text and r.n_tokens == len(r.ids) // 4
    assert byte_bpe.round_trip(docs.where("doc_id < 0")).collect() == []


def test_near_dedup_passes_null_ids_on(spark):
    data = [(3, "a b c d e f g"), (1, "A b c d e F g"), (None, "a b c d e f g"), (None, "a b c d e f g"), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in data], DOCS)
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_components(docs).collect()), key=str)
    assert got == sorted([(1, 1, True), (3, 1, False)] + [(None, None, True)] * 3, key=str)
    kept = sorted(((r.doc_id, r.text) for r in keep_one(docs).collect()), key=str)
    assert kept == sorted([(1, "A b c d e F g"), *data[2:]], key=str)


def test_mix_places_null_ids_last(spark):
    data = [(i, " ".join(["w"] * (i + 3)), "s") for i in range(12)] + [(i, "x y", "t") for i in range(20, 23)]
    data += [(None, "p q r s", "s"), (None, "p q", "t"), (None, "only one", "u"), (None, None, "s")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in data], DOCS)
    for op in (Curriculum(), Curriculum(slice_rows=2)):
        spots = placed(docs, op).collect()
        assert len(spots) == len(data)
        total = {s: sum(len(words(t)) for _, t, x in data if x == s) for s in "stu"}
        taken = {s: sum(r.taken for r in spots if r.source == s) for s in "stu"}
        assert all(r.source_size == total[r.source] and r.words == taken[r.source] for r in spots)
        assert all(r.start >= max((q.start + q.size for q in spots if q.source == r.source and q.doc_id is not None), default=0) for r in spots if r.doc_id is None)
        out = mixed_documents(docs, op).collect()
        assert 2 * abs(sum(len(words(r.text)) for r in out) - sum(taken.values())) <= 3 * max(r.size for r in spots)
        assert {(r.text, r.source) for r in out if r.doc_id is None and r.source == "u"} == {("only one", "u")}


def test_near_dedup_keeps_one_of_repeated_rows(spark):
    rng = random.Random(7)
    a, b = (" ".join(f"{x}{rng.randrange(500)}" for _ in range(60)) for x in "ab")
    data = [(5, a)] * 300 + [(9, a + " end"), (9, a + " end"), (7, b), (7, a + " more"), (5, a.upper()), (4, None), (4, ""), (4, ""), (2, b + " tail"), (8, "alone"), (8, "other")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in data], DOCS)
    got = near_components(docs, NearDedup(block_rows=16)).collect()
    assert len(got) == len(data)
    assert {(r.doc_id, r.component_id) for r in got} == {(5, 5), (9, 5), (7, 5), (7, 2), (2, 2), (4, 4), (8, 8)}
    assert sorted(r.doc_id for r in got if r.kept) == [2, 4, 5, 8, 8]
    kept = sorted(((r.doc_id, r.text) for r in keep_one(docs).collect()), key=str)
    assert kept == sorted([(2, b + " tail"), (4, ""), (5, min(a, a.upper())), (8, "alone"), (8, "other")], key=str)


def test_mix_gives_repeated_rows_places_of_their_own(spark):
    data = [(i, " ".join(["w"] * (i + 3)), f"s{i % 2}") for i in range(12)] + [(3, "r r r r r", "s1")] * 200
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in data], DOCS)
    for op in (Curriculum(), Curriculum(slice_rows=4)):
        spots = placed(docs, op).collect()
        assert len(spots) == len(data)
        for s in ("s0", "s1"):
            mine = sorted((r.start, r.size) for r in spots if r.source == s)
            assert [x for x, _ in mine] == [sum(n for _, n in mine[:k]) for k in range(len(mine))]
            assert sum(r.taken for r in spots if r.source == s) == max(r.words for r in spots if r.source == s)
        out = mixed_documents(docs, op).collect()
        for s in ("s0", "s1"):
            mine = [r for r in spots if r.source == s]
            off = sum(len(words(r.text)) for r in out if r.source == s) - sum(r.taken for r in mine)
            assert 2 * abs(off) <= max(r.size for r in mine)
