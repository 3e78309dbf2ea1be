"""Registered queries: scalar functions, cluster / classifier evaluation, UDF surface
(2.11, 2.14, 2.16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as SC
from ..operators import evaluate as EV
from ..operators.udf import apply_function
from .registry import query, table
from .sqlgen import union_all


def _one(spark, name, value):
    return spark.createDataFrame([(None if value is None else float(value),)], f"{name} double")


# =========================================================================== scalar functions
_URL_LANG = r"^https?://[^/]+/([a-z]{2})/"


@query("regex_extract", f"SELECT page_id, nullif(regexp_extract(url, '{_URL_LANG}', 1), '') AS lang FROM pages")
def q_regex_extract(spark, sf):
    return table(spark, sf, "pages").select("page_id", SC.regex_extract("url", _URL_LANG).alias("lang"))


@query("grade_from_score",
       "SELECT event_id, CASE WHEN value / 10 - 5 < 0 THEN 'A' WHEN value / 10 - 5 < 3 THEN 'B' "
       "WHEN value / 10 - 5 < 11 THEN 'C' WHEN value / 10 - 5 < 19 THEN 'D' "
       "WHEN value IS NOT NULL THEN 'E' END AS grade FROM events")
def q_grade_from_score(spark, sf):
    ev = table(spark, sf, "events").select("event_id", (F.col("value") / 10 - 5).alias("score"))
    return ev.select("event_id", SC.grade_from_score("score").alias("grade"))


@query("tag_prefix_code",
       "SELECT doc_id, nullif(regexp_extract(lang || ':' || source, '^([a-z]{2}):', 1), '') AS code, "
       "nullif(regexp_extract(source, '^([a-z]{2}):', 1), '') AS code_plain FROM documents")
def q_tag_prefix_code(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.concat_ws(":", "lang", "source").alias("tag"), "source")
    return d.select("doc_id", SC.tag_prefix_code("tag").alias("code"), SC.tag_prefix_code("source").alias("code_plain"))


_FLAG = "(?:privacy)|(?:licen[cs]e)"


@query("regex_flag",
       f"SELECT count_if(regexp_matches(text, '(?i){_FLAG}')) AS n_true, "
       f"count_if(NOT regexp_matches(text, '(?i){_FLAG}')) AS n_false, count_if(text IS NULL) AS n_null FROM documents")
def q_regex_flag(spark, sf):
    return table(spark, sf, "documents").agg(*SC.regex_flag_counts("text", _FLAG))


@query("string_functions",
       "SELECT conv_id, turn, upper(role) AS role_upper, lower(role) AS role_lower, length(trim(text)) AS n_trimmed, "
       "len(string_split(text, ' ')) AS n_parts FROM conversations")
def q_string_functions(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", SC.upper("role").alias("role_upper"), SC.lower("role").alias("role_lower"),
                    F.length(SC.trim("text")).alias("n_trimmed"), F.size(SC.split("text", " ")).alias("n_parts"))


@query("row_ratio", "SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS unit_price FROM lineitem")
def q_row_ratio(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", SC.row_ratio("l_extendedprice", "l_quantity").alias("unit_price"))


@query("apply_function", "SELECT doc_id, len(string_split(text, ' ')) AS result FROM documents")
def q_apply_function(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return apply_function(d, "text", lambda s: s.str.split(" ").str.len(), "bigint", vectorized=True).drop("text")


# =========================================================================== cluster metrics
_CENT = ("e AS (SELECT vec_id, label, unnest(CAST(embedding AS DOUBLE[])) AS v, "
         "generate_subscripts(embedding, 1) AS i FROM embeddings), "
         "c AS (SELECT label, i, avg(v) AS cv FROM e GROUP BY 1, 2), "
         "dist AS (SELECT e.vec_id, e.label, sum((e.v - c.cv) * (e.v - c.cv)) AS d2 FROM e JOIN c USING (label, i) "
         "GROUP BY 1, 2), s AS (SELECT label, avg(sqrt(d2)) AS s, count(*) AS n FROM dist GROUP BY 1), "
         "cc AS (SELECT a.label AS la, b.label AS lb, sqrt(sum((a.cv - b.cv) * (a.cv - b.cv))) AS dc FROM c a "
         "JOIN c b ON a.i = b.i AND a.label <> b.label GROUP BY 1, 2), "
         "r AS (SELECT cc.la, max((sa.s + sb.s) / dc) AS m FROM cc JOIN s sa ON sa.label = cc.la "
         "JOIN s sb ON sb.label = cc.lb GROUP BY 1), "
         "g AS (SELECT i, avg(v) AS gv FROM e GROUP BY 1), "
         "bss AS (SELECT sum(s.n * q.sq) AS b FROM s JOIN (SELECT c.label, sum((c.cv - g.gv) * (c.cv - g.gv)) AS sq "
         "FROM c JOIN g USING (i) GROUP BY 1) q USING (label)) ")
# mean squared distance of a row to a cluster, from the cluster's centre and mean square
_SIL = ("sq AS (SELECT vec_id, label, sum(v * v) AS xx FROM e GROUP BY 1, 2), "
        "ms AS (SELECT label, avg(xx) AS mm, count(*) AS n FROM sq GROUP BY 1), "
        "dot AS (SELECT e.vec_id, c.label AS cl, sum(e.v * c.cv) AS xc FROM e JOIN c ON e.i = c.i GROUP BY 1, 2), "
        "md AS (SELECT sq.vec_id, sq.label AS own, dot.cl, sq.xx - 2 * dot.xc + ms.mm AS d, ms.n FROM sq "
        "JOIN dot ON dot.vec_id = sq.vec_id JOIN ms ON ms.label = dot.cl), "
        "pp AS (SELECT vec_id, max(CASE WHEN cl = own THEN n END) AS n_own, max(CASE WHEN cl = own THEN d * n / (n - 1) END) "
        "AS a, min(CASE WHEN cl <> own THEN d END) AS b FROM md GROUP BY 1) ")
_SIL_VALUE = "(SELECT avg(CASE WHEN n_own > 1 THEN (b - a) / greatest(a, b) ELSE 0 END) FROM pp)"
_DB_VALUE = "(SELECT avg(m) FROM r)"
_INERTIA_VALUE = "(SELECT sum(d2) FROM dist)"
_CH_VALUE = ("((SELECT b FROM bss) / ((SELECT count(*) FROM s) - 1)) / "
             "((SELECT sum(d2) FROM dist) / ((SELECT sum(n) FROM s) - (SELECT count(*) FROM s)))")
_SIZE_STD_VALUE = "(SELECT stddev_pop(n) FROM s)"


def _emb(spark, sf):
    return table(spark, sf, "embeddings")


@query("silhouette", "WITH " + _CENT + ", " + _SIL + f"SELECT {_SIL_VALUE} AS silhouette")
def q_silhouette(spark, sf):
    return _one(spark, "silhouette", EV.silhouette(_emb(spark, sf), "embedding", "label"))


@query("silhouette_euclidean",
       "WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), "
       "md AS (SELECT a.vec_id, a.label AS own, b.label AS cl, count(*) AS n, sum(list_distance(a.v, b.v)) AS s "
       "FROM e a, e b GROUP BY ALL), "
       "pp AS (SELECT vec_id, max(CASE WHEN cl = own THEN n END) AS n_own, max(CASE WHEN cl = own THEN s / nullif(n - 1, 0) END) "
       "AS a, min(CASE WHEN cl <> own THEN s / n END) AS b FROM md GROUP BY 1) "
       "SELECT avg(CASE WHEN n_own > 1 THEN (b - a) / greatest(a, b) ELSE 0 END) AS silhouette_euclidean FROM pp")
def q_silhouette_euclidean(spark, sf):
    return _one(spark, "silhouette_euclidean", EV.silhouette_exact(_emb(spark, sf), "embedding", "label", "vec_id"))


@query("davies_bouldin", "WITH " + _CENT + f"SELECT {_DB_VALUE} AS davies_bouldin")
def q_davies_bouldin(spark, sf):
    return _one(spark, "davies_bouldin", EV.davies_bouldin(_emb(spark, sf), "embedding", "label"))


@query("calinski_harabasz", "WITH " + _CENT + f"SELECT {_CH_VALUE} AS calinski_harabasz")
def q_calinski_harabasz(spark, sf):
    return _one(spark, "calinski_harabasz", EV.calinski_harabasz(_emb(spark, sf), "embedding", "label"))


@query("inertia", "WITH " + _CENT + f"SELECT {_INERTIA_VALUE} AS inertia")
def q_inertia(spark, sf):
    return _one(spark, "inertia", EV.inertia(_emb(spark, sf), "embedding", "label"))


@query("cluster_size_std", "SELECT stddev_pop(n) AS cluster_size_std FROM (SELECT label, count(*) AS n "
       "FROM embeddings GROUP BY 1)")
def q_cluster_size_std(spark, sf):
    return _one(spark, "cluster_size_std", EV.cluster_size_std(_emb(spark, sf), "label", k=10))


@query("noise_ratio",
       "SELECT count(DISTINCT CASE WHEN label <> 0 THEN label END) AS n_clusters, count_if(label = 0) AS n_noise, "
       "count_if(label = 0) / count(*) AS noise_ratio FROM embeddings")
def q_noise_ratio(spark, sf):
    return EV.noise_stats(_emb(spark, sf), "label", noise=0)


@query("evaluate_clusters", "WITH " + _CENT + ", " + _SIL + "SELECT * FROM (" + union_all([
    f"SELECT 'silhouette' AS metric, {_SIL_VALUE} AS value", f"SELECT 'davies_bouldin', {_DB_VALUE}",
    f"SELECT 'calinski_harabasz', {_CH_VALUE}", f"SELECT 'inertia', {_INERTIA_VALUE}",
    f"SELECT 'cluster_size_std', {_SIZE_STD_VALUE}"]) + ")")
def q_evaluate_clusters(spark, sf):
    return EV.evaluate_clusters(_emb(spark, sf), "embedding", "label", "kmeans", k=10)


@query("evaluate_density_clusters", "WITH " + _CENT + ", " + _SIL + "SELECT * FROM (" + union_all([
    "SELECT 'n_clusters' AS metric, CAST((SELECT count(*) FROM s WHERE label <> 0) AS DOUBLE) AS value",
    "SELECT 'noise_ratio', (SELECT avg(CAST(label = 0 AS DOUBLE)) FROM embeddings)", f"SELECT 'silhouette', {_SIL_VALUE}",
    "SELECT 'cluster_size_std', (SELECT stddev_pop(n) FROM s WHERE label <> 0)"]) + ")")
def q_evaluate_density_clusters(spark, sf):
    marked = _emb(spark, sf).withColumn("label", F.when(F.col("label") == 0, -1).otherwise(F.col("label")))
    return EV.evaluate_clusters(marked, "embedding", "label", "dbscan")


# =========================================================================== classification
@query("misclassified_rows",
       "SELECT doc_id, quality, toxic, (SELECT avg(CAST(quality IS DISTINCT FROM toxic AS DOUBLE)) FROM labels) AS error_rate "
       "FROM labels WHERE quality IS DISTINCT FROM toxic")
def q_misclassified_rows(spark, sf):
    return EV.misclassified_rows(table(spark, sf, "labels"), "quality", "toxic")


@query("confusion_matrix",
       'SELECT quality AS y_true, count_if(toxic = 0) AS "0", count_if(toxic = 1) AS "1" FROM labels GROUP BY 1')
def q_confusion_matrix(spark, sf):
    return EV.confusion_matrix(table(spark, sf, "labels"), "quality", "toxic")


_REPORT = (
    "pr AS (SELECT quality AS t, toxic AS p, count(*) AS n FROM labels GROUP BY 1, 2), "
    "sup AS (SELECT t AS label, sum(n) AS support FROM pr GROUP BY 1), "
    "pred AS (SELECT p AS label, sum(n) AS predicted FROM pr GROUP BY 1), "
    "tp AS (SELECT t AS label, n AS tp FROM pr WHERE t = p), "
    "per0 AS (SELECT sup.label, coalesce(tp.tp / pred.predicted, 0.0) AS precision, coalesce(tp.tp / sup.support, 0.0) "
    "AS recall, CAST(sup.support AS BIGINT) AS support FROM sup LEFT JOIN pred USING (label) LEFT JOIN tp USING (label)), "
    "per AS (SELECT CAST(label AS VARCHAR) AS label, precision, recall, CASE WHEN precision + recall = 0 THEN 0.0 "
    "ELSE 2 * precision * recall / (precision + recall) END AS f1, support FROM per0) ")


@query("classification_report", "WITH " + _REPORT + "SELECT * FROM (" + union_all([
    "SELECT label, precision, recall, f1, support FROM per",
    "SELECT 'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), (SELECT avg(CAST(quality = toxic AS DOUBLE)) "
    "FROM labels), (SELECT sum(support) FROM per)",
    "SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per",
    "SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), "
    "sum(f1 * support) / sum(support), sum(support) FROM per"]) + ")")
def q_classification_report(spark, sf):
    return EV.classification_report(table(spark, sf, "labels"), "quality", "toxic")


@query("cluster_token_counts",
       "WITH t AS (SELECT lang AS cluster, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+')) AS token "
       "FROM documents), c AS (SELECT cluster, token, count(*) AS count FROM t WHERE length(token) >= 2 GROUP BY 1, 2) "
       "SELECT * FROM (SELECT cluster, token, count, row_number() OVER (PARTITION BY cluster ORDER BY count DESC, token) "
       "AS rank FROM c) WHERE rank <= 100")
def q_cluster_token_counts(spark, sf):
    return EV.cluster_token_counts(table(spark, sf, "documents"), "text", "lang", 100)


