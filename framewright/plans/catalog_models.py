"""Registered queries: file sources / sinks, neighbours, clustering, reduction, models
and compositions (2.1, 2.5, 2.13, 2.7 neighbour imputers)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import cluster as CL
from ..operators import impute as I
from ..operators import model as M
from ..operators import neighbours as N
from ..operators import reduce as RD
from ..operators import relational as R
from ..session import ensure_checkpoint_dir
from ..sources import readers as RDR
from ..sources import sinks as SK
from .compose import representative_sample, resolve_errors
from .registry import doc_labels, events_dirty, part_dirty, query, table, with_views

_LI4 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_P2 = ["p_size", "p_retailprice"]


def scratch(spark) -> str:
    """A fresh folder under the shared checkpoint directory (never machine-local on a cluster)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/fw-scratch/{uuid.uuid4().hex}"


# =========================================================================== sources / sinks
@query("scan_csv", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment "
       "FROM customer")
def q_scan_csv(spark, sf):
    path = scratch(spark)
    SK.sink_csv(table(spark, sf, "customer"), path)
    return RDR.scan_csv(spark, path)


@query("scan_tsv", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def q_scan_tsv(spark, sf):
    path = scratch(spark)
    SK.sink_csv(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"),
                path, sep="\t")
    return RDR.scan_tsv(spark, path)


@query("scan_tsv_gz_limit")
def q_scan_tsv_gz_limit(spark, sf):
    path = scratch(spark)
    (table(spark, sf, "orders").write.option("header", True).option("sep", "\t").option("compression", "gzip")
     .csv(path))
    return RDR.scan_tsv_gz_limit(spark, path, 100)


@query("sink_csv")
def q_sink_csv(spark, sf):
    path = scratch(spark)
    SK.sink_csv(table(spark, sf, "supplier"), path)
    return spark.read.option("header", True).csv(path)


@query("sink_tsv_with_index",
       "SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS \"index\", CAST(n_nationkey AS BIGINT) AS n_nationkey, "
       "n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation")
def q_sink_tsv_with_index(spark, sf):
    path = scratch(spark)
    SK.sink_tsv_with_index(table(spark, sf, "nation"), path, ["n_nationkey"])
    return RDR.scan_tsv(spark, path)


@query("sink_sparse_onehot")
def q_sink_sparse_onehot(spark, sf):
    path = scratch(spark)
    written = SK.sink_sparse_onehot(table(spark, sf, "part").select("p_partkey", "p_type", "p_brand"), path,
                                    key="p_partkey")
    return spark.read.parquet(written["p_brand"])


# =========================================================================== neighbours
def _p2(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")


@query("knn_join",
       "SELECT * FROM (SELECT a.p_partkey AS qid, b.p_partkey AS did, sqrt((a.p_size - b.p_size) * (a.p_size - b.p_size) "
       "+ (a.p_retailprice - b.p_retailprice) * (a.p_retailprice - b.p_retailprice)) AS dist, b.p_retailprice AS payload, "
       "row_number() OVER (PARTITION BY a.p_partkey ORDER BY sqrt((a.p_size - b.p_size) * (a.p_size - b.p_size) + "
       "(a.p_retailprice - b.p_retailprice) * (a.p_retailprice - b.p_retailprice)), b.p_partkey) AS rank "
       "FROM part a JOIN part b ON a.p_partkey <> b.p_partkey) WHERE rank <= 5")
def q_knn_join(spark, sf):
    p = _p2(spark, sf)
    return N.knn_join(p, p, _P2, 5, "p_partkey", "p_partkey", payload="p_retailprice", exclude_self=True)


@query("eps_neighbour_join",
       "SELECT a.p_partkey AS a, b.p_partkey AS b, sqrt((a.p_size - b.p_size) * (a.p_size - b.p_size) + "
       "(a.p_retailprice - b.p_retailprice) * (a.p_retailprice - b.p_retailprice)) AS dist FROM part a JOIN part b "
       "ON a.p_partkey <> b.p_partkey AND abs(a.p_size - b.p_size) <= 1.5 AND abs(a.p_retailprice - b.p_retailprice) <= 1.5 "
       "WHERE sqrt((a.p_size - b.p_size) * (a.p_size - b.p_size) + (a.p_retailprice - b.p_retailprice) * "
       "(a.p_retailprice - b.p_retailprice)) <= 1.5")
def q_eps_neighbour_join(spark, sf):
    return N.eps_neighbour_join(_p2(spark, sf), _P2, 1.5, "p_partkey")


@query("impute_knn")
def q_impute_knn(spark, sf):
    return N.impute_knn(part_dirty(spark, sf).select("p_partkey", "p_size", "p_retailprice"), _P2, "p_partkey", 5)


@query("impute_knn_label")
def q_impute_knn_label(spark, sf):
    df = part_dirty(spark, sf).select("p_partkey", "p_size", "p_retailprice")
    return N.impute_knn_label(df, ["p_retailprice"], "p_size", "p_partkey", 5)


@query("impute_iterative", with_views(
    "m AS (SELECT regr_slope(p_size, p_retailprice) AS b, regr_intercept(p_size, p_retailprice) AS a FROM part_dirty) "
    "SELECT p_partkey, coalesce(CAST(p_size AS DOUBLE), m.a + m.b * p_retailprice) AS p_size, p_retailprice FROM part_dirty, m",
    "part_dirty"))
def q_impute_iterative(spark, sf):
    df = part_dirty(spark, sf).select("p_partkey", "p_size", "p_retailprice")
    return I.impute_iterative(df, ["p_size", "p_retailprice"])


@query("isolation_forest_flag")
def q_isolation_forest_flag(spark, sf):
    from ..operators.iforest import isolation_forest_flag
    ev = table(spark, sf, "events").select("event_id", "value")
    return isolation_forest_flag(ev, "value", "event_id", contamination=0.05, seed=42)


# =========================================================================== sampling / composition
@query("sample_fraction")
def q_sample_fraction(spark, sf):
    return R.sample_fraction(table(spark, sf, "orders"), 0.1, 42)


@query("representative_sample")
def q_representative_sample(spark, sf):
    return representative_sample(part_dirty(spark, sf), 0.1, 42, stratify_by="p_type", key="p_partkey")


@query("resolve_errors", with_views(
    "SELECT DISTINCT event_id, user_id, event_type, abs(value) AS value FROM events_dirty "
    "WHERE event_type IS NOT NULL AND value IS NOT NULL", "events_dirty"))
def q_resolve_errors(spark, sf):
    df = events_dirty(spark, sf).select("event_id", "user_id", "event_type", "value")
    return resolve_errors(df, {"missing_values": "drop", "duplicate_rows": True, "inconsistent_values": True})


# =========================================================================== clustering
def _part_std(spark, sf):
    return CL.assemble_standardized(_p2(spark, sf), _P2)


@query("assemble_and_standardize")
def q_assemble_and_standardize(spark, sf):
    return _part_std(spark, sf)


@query("kmeans_clustering")
def q_kmeans_clustering(spark, sf):
    lab, _sizes = CL.kmeans_clustering(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_LI4),
                                       _LI4, 5, 42)
    return lab


@query("elbow_curve")
def q_elbow_curve(spark, sf):
    return CL.elbow_curve(_part_std(spark, sf), "features", 10)


@query("hierarchical_clusters")
def q_hierarchical_clusters(spark, sf):
    lab, _ = CL.bisecting_kmeans(_part_std(spark, sf), "features", 5)
    return lab.select("p_partkey", "cluster")


@query("gmm")
def q_gmm(spark, sf):
    lab, _ = CL.gmm(_part_std(spark, sf), "features", 5)
    return lab.select("p_partkey", "cluster")


@query("gmm_select_k")
def q_gmm_select_k(spark, sf):
    return CL.gmm_select_k(_part_std(spark, sf), "features", 10)


_DBSCAN_SQL = (
    "WITH RECURSIVE t AS (SELECT avg(p_size) AS ma, stddev_pop(p_size) AS sa, avg(p_retailprice) AS mb, "
    "stddev_pop(p_retailprice) AS sb FROM part), "
    "s AS (SELECT p_partkey AS id, (p_size - ma) / sa AS x, (p_retailprice - mb) / sb AS y FROM part, t), "
    "nb AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM s a JOIN s b ON b.x BETWEEN a.x - 0.15 AND a.x + 0.15 "
    "WHERE sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.15), "
    "core AS MATERIALIZED (SELECT a AS id FROM nb GROUP BY a HAVING count(*) >= 10), "
    "ce AS MATERIALIZED (SELECT a, b FROM nb WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)), "
    "reach AS (SELECT id, id AS r FROM core UNION SELECT ce.b, reach.r FROM reach JOIN ce ON ce.a = reach.id "
    "WHERE reach.r < ce.b), "
    "lab AS (SELECT id, min(r) AS label FROM reach GROUP BY id), "
    "num AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS cluster FROM (SELECT DISTINCT label FROM lab)), "
    "edge AS (SELECT nb.a AS id, min(label) AS label FROM nb JOIN lab ON lab.id = nb.b "
    "WHERE nb.a NOT IN (SELECT id FROM core) GROUP BY nb.a), "
    "every AS (SELECT * FROM lab UNION ALL SELECT * FROM edge) "
    "SELECT s.id AS p_partkey, CAST(coalesce(cluster, -1) AS INTEGER) AS cluster FROM s LEFT JOIN every ON every.id = s.id "
    "LEFT JOIN num ON num.label = every.label")


@query("dbscan", _DBSCAN_SQL)
def q_dbscan(spark, sf):
    std = _part_std(spark, sf)
    return CL.dbscan(std, "features", "p_partkey", eps=0.15, min_samples=10).select("p_partkey", "cluster")


@query("dbscan_noise_cluster", f"SELECT p_partkey, CAST(CASE WHEN cluster = -1 THEN (SELECT max(cluster) + 1 FROM ({_DBSCAN_SQL})) "
       f"ELSE cluster END AS INTEGER) AS cluster FROM ({_DBSCAN_SQL})")
def q_dbscan_noise_cluster(spark, sf):
    return CL.relabel_noise(q_dbscan(spark, sf))


@query("dbscan_grid_search")
def q_dbscan_grid_search(spark, sf):
    return CL.dbscan_grid_search(_part_std(spark, sf), "features", "p_partkey", [0.1, 0.15, 0.2], [5, 10])


@query("fit_predict_score")
def q_fit_predict_score(spark, sf):
    _, score = CL.fit_predict_score(_part_std(spark, sf), "features", "kmeans", 5)
    return spark.createDataFrame([(score,)], "silhouette double")


# =========================================================================== reduction
def _li4(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", *_LI4)


@query("pca")
def q_pca(spark, sf):
    return RD.pca(_li4(spark, sf), _LI4, 2, whiten=True, keep=["l_orderkey", "l_linenumber"])


@query("choose_components")
def q_choose_components(spark, sf):
    return spark.createDataFrame([(RD.choose_components(_li4(spark, sf), _LI4, 0.95),)], "k int")


@query("explained_variance_table",
       "WITH c AS (SELECT abs(corr(p_size, p_retailprice)) AS r, count(*) AS n FROM part) "
       "SELECT 1 AS component, (1 + r) * n / (n - 1.0) AS explained_variance, (1 + r) / 2 AS explained_variance_ratio, "
       "(1 + r) / 2 AS cumulative_ratio FROM c UNION ALL SELECT 2, (1 - r) * n / (n - 1.0), (1 - r) / 2, 1.0 FROM c")
def q_explained_variance_table(spark, sf):
    return RD.explained_variance_table(_p2(spark, sf), _P2)


@query("top_loadings")
def q_top_loadings(spark, sf):
    return RD.top_loadings(_li4(spark, sf), _LI4, 2)


@query("truncated_svd")
def q_truncated_svd(spark, sf):
    return RD.truncated_svd(_li4(spark, sf), _LI4, 2, keep=["l_orderkey", "l_linenumber"])


@query("reconstruct")
def q_reconstruct(spark, sf):
    return RD.reconstruct(_li4(spark, sf), _LI4, 2, keep=["l_orderkey", "l_linenumber"])


@query("reconstruction_mse")
def q_reconstruction_mse(spark, sf):
    return spark.createDataFrame([(RD.reconstruction_mse(_li4(spark, sf), _LI4, 2),)], "mse double")


@query("project_2d")
def q_project_2d(spark, sf):
    return RD.project_2d(_li4(spark, sf), _LI4, keep=["l_orderkey", "l_linenumber", "l_returnflag"])


# =========================================================================== models
@query("regression_compare")
def q_regression_compare(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("key", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    return M.regression_compare(li, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", "key", trees=100)


@query("rf_classifier_importances")
def q_rf_classifier_importances(spark, sf):
    return M.rf_classifier_importances(doc_labels(spark, sf), ["n_chars", "toxic"], "quality", "doc_id", trees=100)
