"""Every stage of the pipeline against plain Python on its own input."""

import duckdb
import numpy as np
import public_tokenizers
import tiktoken
from brute import dedup_lines, mix, near_components, words

import corpus_pipeline
from tsforge.llm import byte_bpe
from tsforge.llm.common import written
from tsforge.llm.quality_crf import trained
from tsforge.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    tables = []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "stage")
        tables.append(docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    quality, lines, near, mixed, tokens = tables

    model = trained(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    want = {i for i, r in before.items() if model.quality([r.text.encode()])[0] >= 0.3}
    assert {r.doc_id for r in quality} == want and all(before[r.doc_id] == r for r in quality)

    assert {r.doc_id: r.text for r in lines} == dedup_lines([(r.doc_id, r.text) for r in quality])

    groups = near_components([(r.doc_id, r.text) for r in lines], 80)
    assert sorted(r.doc_id for r in near) == sorted(i for i, (_, c) in groups.items() if c == i)

    plan = mix([(r.doc_id, r.text, r.source) for r in near])
    taken = {}
    for r in mixed:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(words(r.text))
    sources = {}
    for i, p in plan.items():  # whole documents only: a source ends within half of its border document
        sources.setdefault(before[i].source, []).append(i)
        assert taken.get(i, 0) in [k * p[0] for k in range(4)] and abs(taken.get(i, 0) - p[3]) <= p[0] / 2
    assert all(sum(taken.get(i, 0) != plan[i][3] for i in ids) <= 1 for ids in sources.values())

    own = byte_bpe.load(byte_bpe.default_path(), public_tokenizers.PATTERN)
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    assert sorted((r.doc_id, r.text) for r in tokens) == sorted((r.doc_id, r.text) for r in mixed)
    for r in tokens:
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == coder.encode_ordinary(r.text) and r.n_tokens == len(r.ids) // 4


def test_queries_with_sql_match_it(spark):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, sql in ORACLES.items():
        df = QUERIES[name](spark, SF)
        cur = con.execute(sql)
        names = [d[0] for d in cur.description]
        key = lambda t: tuple((x is None, x) for x in t)
        want = sorted(cur.fetchall(), key=key)
        got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=key)
        assert got == want and set(names) == set(df.columns), name


def test_null_id_goes_through_dedup_and_mix(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    named = docs.limit(1).selectExpr("CAST(NULL AS BIGINT) AS doc_id", *[f"`{c}`" for c in docs.columns if c != "doc_id"])
    docs = written(docs.unionByName(named.selectExpr(*[f"'only here' AS {c}" if c in ("text", "source") else f"`{c}`" for c in docs.columns])), "stage")
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = written(stage(spark, docs, SF), "stage")
        assert {r.text for r in docs.where("doc_id IS NULL").collect()} == {"only here"}
