"""HTML text, language, quality, top-k and neighbours; the registered queries."""

import os
import time
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsforge.llm import byte_bpe
from tsforge.llm.html_text import extracted, main_text
from tsforge.llm.language_id import Hyper, _Counts, _Letters, identified, prototypes
from tsforge.llm.line_dedup import dedup_lines
from tsforge.llm.quality_crf import LineCRF, forward_backward, line_features, scored, trained
from tsforge.llm.queries import ORACLES, QUERIES
from tsforge.llm.rotated_bits import encoded, index, nearest, rotation
from tsforge.llm.threshold_topk import top_k

SF = os.environ.get("LLM_TEST_SF", "/root/testdata/sf0.01")


def test_html_structures():
    long = "word " * 60
    page = f"""<html><head><title>T</title><style>p{{}}</style><script>var a = "<p>no</p>";</script></head><body>
    <header><p>Site name</p></header><nav><ul><li><a href="/">Home</a></ul></nav><div class="cookie-notice">We use cookies</div>
    <div id="content"><h1>A &amp; B&nbsp;C</h1><p>{long}<p>second <b>bo</b>ld<br>line<aside>aside</aside><ul><li>one<li>two</ul>
    <form><input><p>Sign up</p></form><p>last</div><div class="comments"><p>{long}</p></div><footer>&copy;</footer>"""
    assert main_text(page) == "\n".join(["A & B C", long.strip(), "second bold line", "one", "two", "last"])


def test_html_article_inside_unclosed_boilerplate_and_short_pages():
    assert main_text("<div class=ad>x<article><p>short<p hidden>no<p>b &lt;i&gt;</article>") == "short\nb <i>"
    assert main_text("") == "" and main_text("<p>  </p>") == "" and main_text("<nav>a</nav>") == ""
    assert main_text("plain\n text") == "plain text"
    assert main_text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>") == "deep"


@pytest.mark.parametrize("attrs", ['class="content has-sidebar"', 'id="page" class="with-header"', 'class="post no-comments"', 'id="social-science"', 'class="share"', 'class="widget"'])
def test_html_wrappers_around_the_text_stay(attrs):
    body = "<h1>Title</h1>" + "".join(f"<p>{'word ' * 40}{k}</p>" for k in range(4))
    page = f'<body><nav><a href="/">Home</a></nav><div {attrs}>{body}<div class="sidebar-left"><p>{"more " * 9}</p></div></div></body>'
    assert main_text(page) == "\n".join(["Title", *(f"{'word ' * 40}{k}" for k in range(4))])


def test_html_names_by_whole_words():
    text = "word " * 40
    page = f'<article><div class="entry-header"><h1>Title</h1></div><p>{text}</p><section id="social-science"><p>part</p></section><div class="social-share">x</div><ul class="comment-list"><li>y</ul></article>'
    assert main_text(page) == f"Title\n{text.strip()}\npart"
    assert main_text(f'<div class="post"><p>{text}</p></div><div class="comments-area"><p>{text * 3}</p></div>') == text.strip()


def test_html_broken_markup_never_ends_the_job():
    body = "<article><p>One long paragraph of plain words stands here.</p>{}<p>And a second one follows it.</p></article>"
    want = "One long paragraph of plain words stands here.\nAnd a second one follows it."
    for junk in ("<![foo[x]]>", "<![if !IE]>", "<![endif]>", "<![ ]>", "<!>", "<![CDATA[x]]>", "<?php x ?>", "</>", "<!-- -- -->"):
        assert main_text(body.format(junk)) == want, junk
    assert main_text(body.format("") + "<!-- <p>left open") == want
    for junk in ("<![", "<!", "<![foo", "<a href='", "&#x110000;", "&#xD800;", "<!--"):
        assert isinstance(main_text(body.format("") + junk), str)


def test_html_lines_of_links_go():
    text = "plain words stand here in a row " * 6
    p, t = f"<p>{text}</p>", text.strip()
    assert main_text(f"<body><div><a href=/>News</a></div>{p}{p}<div><a href=/>More</a></div></body>") == f"{t}\n{t}"
    assert main_text(f"<article><h1><a href=/>Head</a></h1>{p}<ul><li><a>one</a></li><li><a>two</a></li></ul>{p}</article>") == f"Head\n{t}\n{t}"
    assert main_text(f"<article><p>See <a>this</a> page.</p>{p}<p><a>linked</a></p>{p}</article>") == f"See this page.\n{t}\nlinked\n{t}"


def test_html_forms_and_several_articles():
    text = "plain words stand here in a row " * 6
    p, t = f"<p>{text}</p>", text.strip()
    assert main_text(f"<body><form id=page><nav>x</nav><h1>T</h1>{p}{p}</form></body>") == f"T\n{t}\n{t}"
    assert main_text(f"<article>{p}<form><p>Sign up</p></form></article>") == t
    assert main_text(f"<article><h1>A</h1>{p}</article><article><h1>B</h1>{p}</article><article>teaser</article>") == f"A\n{t}\nB\n{t}"
    assert main_text(f'<article>{p}<article class="comment">{p}</article></article><article class="comment">{p}</article>') == t


def test_html_nesting_is_linear():
    def seconds(n):
        page = "<article>" + "<div class=ad>" * n + "x" + "<p>y</p></div>" * n
        start = time.process_time()
        main_text(page)
        return time.process_time() - start

    assert seconds(24_000) < 24 * seconds(3_000)  # eight times the page; sixty-four times the work if quadratic


def test_helper_columns_never_clash(spark):
    names = ("_html", "html", "_text", "text_", "_source", "source", "source_", "id", "kept", "a.b")
    docs = spark.createDataFrame([(1, "some words here\nsome words here", 5)], "doc_id long, t string, n_chars int").withColumns({n: F.lit(n) for n in names if n not in ("html",)})
    pages = docs.withColumn("html", F.lit("<p>x</p>"))
    langs, profile = prototypes(docs.withColumn("lang", F.lit("en")), text_col="t")
    model = trained(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"), text_col="t")
    for done in (extracted(pages), scored(docs, model, text_col="t"), identified(docs, langs, profile, text_col="t"), byte_bpe.encoded(docs, "t"), dedup_lines(docs, text_col="t")):
        row = done.first().asDict()
        assert all(row[n] == n for n in names if n != "html" and n in row) and {"a.b", "_text", "_source", "id", "kept"} <= set(row)


def test_language_counts_are_sparse():
    rng = np.random.default_rng(0)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x5200, 300))) for _ in range(100)] + [None, ""]
    tracemalloc.start()
    counts = _Counts(texts, 3)
    assert tracemalloc.get_traced_memory()[1] < 4 << 20  # 30,000 distinct trigrams: 12 MB as a table
    tracemalloc.stop()
    assert len(counts.at) <= 100 * 300 and len(counts.codes) <= len(counts.at)
    got = counts.bundled(_Letters(Hyper()))
    assert np.allclose(got[7], _Counts(texts[7:8], 3).bundled(_Letters(Hyper()))[0]) and not got[100:].any()
    assert np.allclose(counts.bundled(_Letters(Hyper()), np.arange(102) % 2)[1], got[1::2].sum(axis=0), atol=1e-2)


def test_html_rows(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, "<article><p>t</p></article>", "z"), (3, "<article><p>t</p></article>", "z")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = sorted((r.page_id, r.text) for r in extracted(pages).collect())
    assert got == [(1, ""), (2, ""), (3, "t"), (3, "t")]
    assert extracted(pages.where("page_id < 0")).collect() == []


def test_html_query_finds_the_article(spark):
    """Against the article element of the given pages, read with a plain pattern."""
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op2_html_text"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        body = pages[r.page_id].split("<article>")[1].split("</article>")[0].split("<footer")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", re.sub("<br>", " ", b))).split()) for b in re.split("</?p>|</?h1>", body)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_language_special_rows(spark):
    texts = [("der die das und nicht", "de"), ("the and of with this", "en"), (None, "en"), ("12 34", "en"), ("x", None)]
    train = spark.createDataFrame(texts * 3, "text string, lang string")
    langs, profile = prototypes(train)
    assert langs == ["de", "en"] and np.allclose(np.linalg.norm(profile, axis=1), 1)
    docs = spark.createDataFrame([(1, "und die"), (2, "of this"), (3, None), (4, ""), (5, "1 2!"), (6, "of " * 40_000), (6, "of " * 40_000)], "doc_id long, text string")
    docs = docs.withColumn("score", F.lit("clash"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in identified(docs, langs, profile).collect()}
    assert [got[i][0] for i in range(1, 7)] == ["de", "en", "und", "und", "und", "en"]
    assert all(0 <= s <= 1 for _, s in got.values()) and got[3][1] == 0
    none, empty = prototypes(train.where("lang = 'zz'"))
    assert none == [] and {r.lang_pred for r in identified(docs, none, empty).collect()} == {"und"}


def test_language_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op3_language_id"](spark, SF).collect()
    assert len(got) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out and lang[r.doc_id] is not None]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    doc = np.array([0, 0, 0, 1, 2, 2])
    score, table = rng.normal(size=6), rng.normal(size=(2, 2))
    good, expected = forward_backward(score, doc, table)
    want, pairs = np.zeros(6), np.zeros((2, 2))
    for d in range(3):
        at = np.flatnonzero(doc == d)
        paths = [[(k >> i) & 1 for i in range(len(at))] for k in range(2 ** len(at))]
        weight = np.exp([sum(score[a] * y for a, y in zip(at, p)) + sum(table[p[i], p[i + 1]] for i in range(len(at) - 1)) for p in paths])
        weight /= weight.sum()
        for p, q in zip(paths, weight):
            want[at] += q * np.array(p)
            for i in range(len(at) - 1):
                pairs[p[i], p[i + 1]] += q
    assert np.allclose(good, want) and np.allclose(expected, pairs)


def test_quality_special_rows(spark):
    good, bad = "These are plain words in a line of text.\nAnd another one follows it here.", "BUY!! NOW!! ### BUY!! NOW!!\n### !!!"
    docs = spark.createDataFrame([(i, good if i % 2 else bad, 5) for i in range(40)] + [(100, None, 5), (101, "", 5), (102, " \n ", 5), (103, "word " * 60_000, 5)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(100, 1), (3, None), (None, 1)], "doc_id long, quality int")
    model = trained(docs, labels, LineCRF(sample_docs=30))
    got = {r.doc_id: (r.score, r.predicted) for r in scored(docs, model).collect()}
    assert all(got[i][1] == i % 2 for i in range(40)) and [got[i] for i in (100, 101, 102)] == [(0.0, 0)] * 3
    assert 0 <= got[103][0] <= 1
    assert scored(docs.where("doc_id < 0"), model).collect() == []
    for some in (labels.where("quality = 1"), labels.where("doc_id < 0")):  # one label, none
        assert all(0 <= r.score <= 1 for r in scored(docs, trained(docs, some)).collect())
    assert line_features([b"", b" "])[0].shape == (0, 11)


def test_quality_held_out_accuracy(spark):
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = QUERIES["op8_quality_crf"](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in got)
    held = [(r.score, quality[r.doc_id]) for r in got if r.held_out and r.doc_id in quality]
    assert np.mean([(s >= 0.3) == q for s, q in held]) > 0.97
    assert min(s for s, q in held if q) > 0.3  # clean documents stay


def vectors(spark, seed=0, n=300, dim=16):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) / 4
    x[n // 2 :: 3] = x[0]  # many equal rows: ties
    rows = [(i, x[i].astype(np.float32).tolist()) for i in range(n)]
    odd = [(1000, None), (1050, [None] + [0.1] * (dim - 1)), (1100, [float("nan")] * dim), (1150, [float("inf")] * dim), (1200, []), (None, [0.1] * dim)]
    return spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("v", F.lit("clash")), {i: np.array(v) for i, v in rows}


@pytest.mark.parametrize("sizes", [(2048, 8192, 2048), (2, 40, 9)])
def test_top_k_equals_brute_force(spark, sizes):
    df, x = vectors(spark)
    got = {}
    for r in top_k(df, df.where("vec_id % 50 = 0"), 5, 256, *sizes).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    q = {i: np.floor(256 * v.astype(np.float32).astype(float)).astype(int) for i, v in x.items()}
    for i in range(0, 300, 50):
        want = sorted(((-int(q[i] @ q[j]), j) for j in q if j != i))[:5]
        assert got.pop(i) == {k + 1: (j, -s) for k, (s, j) in enumerate(want)}
    assert got == {}


def test_top_k_of_few_rows_and_huge_numbers(spark):
    df = spark.createDataFrame([(0, [3e14, 1.0]), (1, [3e14, 2.0]), (2, [0.0, 0.0])], "vec_id long, embedding array<double>")
    got = [(r.rank, r.vec_id) for r in top_k(df, df.where("vec_id = 0"), 5, 1).orderBy("rank").collect()]
    assert got == [(1, 1), (2, 2)]
    assert top_k(df.where("vec_id < 0"), df.where("vec_id < 0")).collect() == []


@pytest.mark.parametrize("sizes", [(1024, 8192, 4096), (2, 60, 7)])
def test_neighbours_have_exact_scores_and_high_recall(spark, sizes):
    df, x = vectors(spark, 1)
    codes = index(df.unionByName(spark.createDataFrame([(5000, [0.0] * 16)], "vec_id long, embedding array<float>").withColumn("v", F.lit("z"))))
    assert codes.count() == len(x)
    got = {}
    for r in nearest(codes, codes.where("vec_id % 50 = 0"), 5, 2.5, *sizes).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hit = 0
    for i in range(0, 300, 50):
        a = x[i].astype(np.float32).astype(float)
        cos = {j: float((v := x[j].astype(np.float32).astype(float)) @ a / np.linalg.norm(v) / np.linalg.norm(a)) for j in x if j != i}
        want = sorted(cos, key=lambda j: (-round(cos[j], 12), j))[:5]
        hit += len(set(want) & {v for v, _ in got[i].values()})
        assert all(abs(cos[j] - s) < 1e-12 for j, s in got[i].values()) and len(got[i]) == 5
    assert hit >= 0.9 * 30


def test_codes_estimate_within_their_bound():
    rng = np.random.default_rng(4)
    x, q = rng.normal(size=(2000, 64)), rng.normal(size=64)
    bits, f = encoded(x)
    signs = np.unpackbits(bits, axis=1, count=64) * 2.0 - 1
    guess = signs @ (rotation(64) @ (q / np.linalg.norm(q))) / 8 / f
    true = x @ q / np.linalg.norm(x, axis=1) / np.linalg.norm(q)
    assert np.mean(np.abs(guess - true) <= 2.5 * np.sqrt((1 - f * f) / (f * f) / 63)) > 0.97


def test_queries_are_registered_once_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
