"""The registered queries of this package, each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge.llm.byte_bpe import round_trip
from tsforge.llm.collocations import collocations
from tsforge.llm.common import exchanges
from tsforge.llm.decontamination import contamination
from tsforge.llm.html_text import extracted
from tsforge.llm.language_id import fold, identified, prototypes
from tsforge.llm.line_dedup import dedup_lines
from tsforge.llm.mixing import Curriculum, placed, position
from tsforge.llm.near_dedup import NearDedup, near_components
from tsforge.llm.prefix_trie import prefix_trie
from tsforge.llm.quality_crf import scored, trained
from tsforge.llm.repeated_passages import repeated_passages
from tsforge.llm.rotated_bits import index, nearest
from tsforge.llm.threshold_topk import top_k

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets share 85 % of their union."""
    return near_components(table(spark, sf, "documents"), NearDedup(threshold_pct=85))


@query
def op2_html_text(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of every page."""
    pages = extracted(table(spark, sf, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op7_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Every document encoded and decoded again, as digests of ids and bytes."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    done = round_trip(table(spark, sf, "documents").select("doc_id", "text"), path)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op10_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    """What the mix takes of every document, in the order of the document's first training position."""
    op = Curriculum()
    spots = placed(table(spark, sf, "documents"), op)
    first = F.when(F.col("taken") > 0, position(F.col("start"), F.least("size", F.col("words") - F.col("start")), op))
    spots = spots.withColumn("position", F.round(first, 9))
    spots = spots.repartitionByRange(exchanges(spark), "position", "doc_id").sortWithinPartitions("position", "doc_id")
    return spots.select("doc_id", "size", "source_size", "target", "taken", "position")


ORACLES["op10_source_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(CAST(doc_id AS VARCHAR)) AS draw
  FROM documents
), src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) - 1 AS r
  FROM sized GROUP BY source
), w AS (
  SELECT *, [1, 2, 3][CAST(r % 3 + 1 AS INTEGER)] AS weight, 3 * source_size AS cap FROM src
), l AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0) AS DOUBLE)
         / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS DOUBLE) AS rate
  FROM w WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT *, least(CAST(cap AS DOUBLE), coalesce(weight * (
      SELECT arg_min(rate, (CAST(cap AS DOUBLE) / weight, r)) FROM l WHERE rate * weight <= cap), 0.0)) AS target
  FROM l
), p AS (
  SELECT s.doc_id, s.size, t.source_size, t.r, t.target, CAST(round(t.target) AS BIGINT) AS words,
         CAST(coalesce(sum(s.size) OVER (PARTITION BY t.r ORDER BY s.draw, s.doc_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized s JOIN t ON s.source IS NOT DISTINCT FROM t.source
), k AS (
  SELECT *, CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS passes FROM p
), q AS (
  SELECT *, CAST(passes * size + least(size, greatest(0, words - passes * source_size - start)) AS BIGINT) AS taken FROM k
), u AS (
  SELECT *, (start + least(size, words - start) / 2.0) / words AS part, CAST(r % 3 AS INTEGER) AS kind FROM q
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, taken,
       CASE WHEN taken > 0 THEN round(CASE
         WHEN kind = 0 THEN (sqrt(greatest(0.0, 9.0 - 4.0 * (part * 2.0))) - 3.0) / -2.0
         WHEN kind = 1 THEN part
         WHEN part * 1.5 <= 0.75 THEN (sqrt(greatest(0.0, 1.0 + 4.0 * (part * 1.5))) - 1.0) / 2.0
         ELSE 0.5 + least(0.5, (sqrt(greatest(0.0, 4.0 - 4.0 * (part * 1.5 - 0.75))) - 2.0) / -2.0) END, 9) END AS position
FROM u
"""


@query
def op3_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document, learnt from the two folds whose number is not 1."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    langs, profile = prototypes(docs.where(fold("doc_id", 3) != 1))
    found = identified(docs.select("doc_id", "text"), langs, profile)
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op8_quality_crf(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of every document, learnt from labels outside fold 0."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").where(fold("doc_id", 5) != 0)
    done = scored(docs, trained(docs, labels)).select("doc_id", "score", "predicted")
    return done.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query
def op4_threshold_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The five largest integer inner products of every fiftieth vector with all others."""
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


ORACLES["op4_threshold_topk"] = """
WITH ok AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM ok q JOIN ok c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op6_rotated_bits(spark: SparkSession, sf: str) -> DataFrame:
    """The five nearest vectors by cosine of every fiftieth vector."""
    codes = index(table(spark, sf, "embeddings").select("vec_id", "embedding"))
    return nearest(codes, codes.where("vec_id % 50 = 0"))


@query
def op9_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the lines that an earlier line matches, as a digest."""
    lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long")
    docs = table(spark, sf, "documents").select("doc_id", "text", lines.alias("n_lines"))
    return dedup_lines(docs).select("doc_id", "n_lines", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("kept_md5"))


ORACLES["op9_line_dedup"] = r"""
WITH line AS (
  SELECT doc_id, CAST(unnest(range(len(string_split(text, chr(10))))) AS INTEGER) AS line_no,
         unnest(string_split(text, chr(10))) AS line
  FROM documents
), sets AS (
  SELECT doc_id, line_no, list_sort(list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS w FROM line
), firsts AS (
  SELECT w, min((doc_id, line_no)) AS id, len(w) AS n FROM sets WHERE len(w) > 0 GROUP BY w
), freq AS (
  SELECT t, count(*) AS f FROM (SELECT unnest(w) AS t FROM firsts) GROUP BY t
), placed AS (
  SELECT id, n, t, row_number() OVER (PARTITION BY id ORDER BY f, t) AS pos
  FROM (SELECT id, n, unnest(w) AS t FROM firsts) JOIN freq USING (t)
), prefix AS (
  SELECT id, n, t FROM placed WHERE pos <= n - (80 * n + 99) // 100 + 1
), pairs AS (
  SELECT DISTINCT y.id AS y, x.id AS x
  FROM prefix y JOIN prefix x ON y.t = x.t AND x.id < y.id AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
), gone AS (
  SELECT DISTINCT y FROM pairs JOIN firsts a ON a.id = y JOIN firsts b ON b.id = x
  WHERE 180 * len(list_intersect(a.w, b.w)) >= 80 * (a.n + b.n)
), kept AS (
  SELECT l.doc_id, l.line_no, l.line FROM line l JOIN sets s USING (doc_id, line_no)
  WHERE len(s.w) = 0 OR ((l.doc_id, l.line_no) IN (SELECT id FROM firsts) AND (l.doc_id, l.line_no) NOT IN (SELECT y FROM gone))
), texts AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS kept FROM kept GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(string_split(coalesce(d.text, ''), chr(10))) AS BIGINT) AS n_lines,
       CASE WHEN d.text IS NOT NULL THEN CAST(length(coalesce(t.kept, '')) AS BIGINT) END AS n_chars,
       CASE WHEN d.text IS NOT NULL THEN md5(coalesce(t.kept, '')) END AS kept_md5
FROM documents d LEFT JOIN texts t USING (doc_id)
"""


@query
def op5_repeated_passages(spark: SparkSession, sf: str) -> DataFrame:
    """Spans of fifty and more words that several documents share."""
    return repeated_passages(table(spark, sf, "documents"))


@query
def op12_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Which words of every document lie in a ten-word window of a benchmark item, and of which items."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf, "benchmark").select("item_id", "text"))
    n_items = F.size("items").cast("long")
    digest = F.sha2(F.concat_ws(",", "items"), 256)
    return found.select("doc_id", "n_words", "n_hit", n_items.alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLES["op12_benchmark_decontamination"] = r"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, list_slice(w, p, p + least(10, len(w)) - 1) AS ws
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM item WHERE len(w) > 0)
), doc AS (
  SELECT row_number() OVER () AS d, doc_id, coalesce(
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), place AS (
  SELECT d, n, p, list_slice(w, p, p + n - 1) AS ws
  FROM (SELECT d, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
), hit AS (
  SELECT d, p, n, item FROM place JOIN win USING (n, ws)
), words AS (
  SELECT d, count(DISTINCT q) AS n_hit FROM (SELECT d, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT d, p, n FROM hit)) GROUP BY d
), items AS (
  SELECT d, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT d, item FROM hit WHERE item IS NOT NULL) GROUP BY d
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (d) LEFT JOIN items USING (d)
"""


@query
def op13_phrase_collocations(spark: SparkSession, sf: str) -> DataFrame:
    """Phrases of two to four words that stand together, the first 2000 of each language."""
    return collocations(table(spark, sf, "documents").select("text", "lang"))


ORACLES["op13_phrase_collocations"] = r"""
WITH piece AS (
  SELECT lang, row_number() OVER () AS id, regexp_extract_all(p, '[^ 	]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS p
        FROM documents)
), gram AS (
  SELECT lang, k, w[i:i + k - 1] AS ws
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM piece, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)
), total AS (
  SELECT lang, sum(len(w)) AS n FROM piece GROUP BY lang
), freq AS (
  SELECT lang, k, ws, count(*) AS f FROM gram GROUP BY lang, k, ws HAVING count(*) >= 30
), cand AS (
  SELECT * FROM freq WHERE k > 1
), halves AS (
  SELECT lang, k, ws, f, j, ws[1:j] AS x, ws[j + 1:k] AS y FROM (SELECT *, unnest(range(1, k)) AS j FROM cand)
), scored AS (
  SELECT c.lang, c.k, c.ws, c.f, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * c.f // (x.f::HUGEINT + y.f) AS BIGINT) AS score,
         row_number() OVER (PARTITION BY c.lang, c.ws ORDER BY 2000000::HUGEINT * c.f // (x.f::HUGEINT + y.f), c.j) AS pick
  FROM halves c JOIN freq x ON x.lang = c.lang AND x.ws = c.x JOIN freq y ON y.lang = c.lang AND y.ws = c.y
), cover AS (
  SELECT lang, s AS ws, max(f) AS over
  FROM (SELECT lang, f, ws[i:i + m - 1] AS s
        FROM (SELECT lang, f, ws, k, m, unnest(range(1, k - m + 2)) AS i FROM cand, (SELECT unnest([2, 3]) AS m) WHERE m < k)) GROUP BY lang, s
), kept AS (
  SELECT s.*, array_to_string(s.ws, ' ') AS phrase FROM scored s LEFT JOIN cover v ON v.lang = s.lang AND v.ws = s.ws
  WHERE pick = 1 AND NOT coalesce(100::HUGEINT * v.over >= 80::HUGEINT * s.f, false)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS rank FROM kept
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(f AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


@query
def op11_conversation_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    """Every distinct prefix of the rebuilt conversations with its members, children, leaves and savings."""
    return prefix_trie(table(spark, sf, "conversations").select("conv_id", "turn", "role", "text"))


ORACLES["op11_conversation_prefix_trie"] = """
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(md5(coalesce(role, '')) || ':' || md5(coalesce(text, '')))) AS pos,
         md5(md5(coalesce(role, '')) || ':' || md5(coalesce(text, ''))) AS t, strlen(coalesce(text, '')) AS bytes
  FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
  SELECT conv_id, conv_id - conv_id % 5 AS head,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
           lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)::BIGINT[]), lambda c, i: xor(c >> 1, (c & 1) * 3988292384)))) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), part AS (
  SELECT c.conv_id, 0 AS own, pos, t, bytes FROM conv c JOIN turns x ON x.conv_id = c.head AND x.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, pos, t, bytes FROM conv c JOIN turns x ON x.conv_id = c.conv_id AND x.pos > c.h
), seq AS (
  SELECT conv_id, row_number() OVER w AS depth, list(t) OVER w AS prefix, bytes
  FROM part WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), every AS (
  SELECT conv_id, depth, prefix, bytes FROM seq UNION ALL SELECT conv_id, 0, CAST([] AS VARCHAR[]), 0 FROM conv
), node AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM every GROUP BY prefix, depth
), last AS (
  SELECT conv_id, max(depth) AS depth FROM every GROUP BY conv_id
), ended AS (
  SELECT prefix, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM every JOIN last USING (conv_id, depth) GROUP BY prefix
), kids AS (
  SELECT prefix[1:depth - 1] AS prefix, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1
), shape AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children FROM node n LEFT JOIN kids k USING (prefix)
), above AS (
  SELECT prefix[1:d] AS prefix, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM shape) GROUP BY 1
)
SELECT s.conv_id, CAST(s.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, s.n_convs, s.n_children, CAST(a.n_leaves AS BIGINT) AS n_leaves,
       CAST(a.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM shape s JOIN above a USING (prefix) LEFT JOIN ended e USING (prefix) LEFT JOIN node p ON s.depth > 0 AND p.prefix = s.prefix[1:s.depth - 1]
"""
