"""The numbered queries: each applies its operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann_multiprobe,
    budget_mix,
    difference_packing,
    feistel_pii,
    line_dedup,
    mil_quality,
    multi_index,
    piece_codec,
    set_join,
    source_audit,
    token_align,
    url_boosting,
    vector_packing,
)
from .frames import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def add(fn):
        QUERIES[key] = fn
        if sql:
            ORACLE[key] = sql
        return fn
    return add


@query("op1_line_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.mark(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op2_ann_multiprobe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_multiprobe.search(read_table(spark, sf_dir, "embeddings"))


@query("op3_multi_index", """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
good AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS w FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.98),
reach AS (SELECT vec_id AS u, vec_id AS w FROM v UNION SELECT r.u, l.w FROM reach r JOIN links l ON r.w = l.u),
low AS (SELECT u, min(w) AS component_id FROM reach GROUP BY u)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE links.u = v.vec_id) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN low ON low.u = v.vec_id""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.link(read_table(spark, sf_dir, "embeddings"))


@query("op4_piece_codec")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = piece_codec.encode(read_table(spark, sf_dir, "documents").select("doc_id", "text"), check="round_trip")
    return docs.select("doc_id", "ids", F.size("ids").alias("n_tokens"), "round_trip")


@query("op5_url_boosting")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_boosting.judge(read_table(spark, sf_dir, "pages"))


@query("op6_set_join", """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM w),
s AS MATERIALIZED (SELECT DISTINCT doc_id, md5(s) AS s FROM g),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS u, b.doc_id AS w, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT u, w FROM common JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = w WHERE 100 * c >= 85 * (x.n + y.n - c)),
sym AS (SELECT u, w FROM links UNION ALL SELECT w, u FROM links),
reach AS (SELECT doc_id AS u, doc_id AS w FROM documents UNION SELECT r.u, l.w FROM reach r JOIN sym l ON r.w = l.u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT u, min(w) AS component_id FROM reach GROUP BY u) r ON r.u = d.doc_id""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return set_join.join(docs).select("doc_id", "n_shingles", "component_id")


@query("op7_feistel_pii")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel_pii.pseudonymise(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op8_mil_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return mil_quality.score(docs, read_table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@query("op9_vector_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_packing.shard(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op10_budget_mix")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return budget_mix.mix(docs, "doc_id", "source", "text").select("doc_id", "size", "source_size", "target", "taken")


@query("op11_source_audit", """
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS MATERIALIZED (SELECT lang, source, r, term, count(*) AS n FROM (SELECT lang, source, r, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS MATERIALIZED (SELECT lang, term, sum(n) AS total FROM t GROUP BY ALL HAVING count(*) >= 30),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
grp AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
has AS MATERIALIZED (SELECT lang, source, term, sum(n) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
own AS (SELECT lang, source, sum(n) AS n FROM has GROUP BY ALL),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS c, k.total, v.n AS lang_n, v.v,
                          1 + 1000000000 * (coalesce(h.n, 0) + 5)::HUGEINT // (coalesce(o.n, 0) + 5 * v.v) AS p
      FROM grp g JOIN kept k ON k.lang = g.lang JOIN v ON v.lang = g.lang LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source
      LEFT JOIN has h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.f, 0) AS f FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS f FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) s
         ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term AS (SELECT lang, source, term AS item, p - (1 + 1000000000 * (total + 5)::HUGEINT // (lang_n + 5 * v)) AS f FROM p WHERE c > 0),
every AS (SELECT lang, source, 'pair' AS part, item, f FROM pair UNION ALL SELECT lang, source, 'term', item, f FROM term WHERE f > 0)
SELECT lang, source, part, item, CAST(f AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY f DESC, item) AS INTEGER) AS rank
FROM every QUALIFY part = 'pair' OR rank <= 50""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(read_table(spark, sf_dir, "documents"))


@query("op12_token_align")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align(read_table(spark, sf_dir, "documents"))


@query("op13_difference_packing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return difference_packing.pack(read_table(spark, sf_dir, "documents"))
