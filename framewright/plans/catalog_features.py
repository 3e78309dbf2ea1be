"""Registered queries: joins, aggregations, sampling, encoders, outliers, scaling,
imputation and column selection (2.4-2.10, 2.12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode as E
from ..operators import impute as I
from ..operators import outliers as O
from ..operators import relational as R
from ..operators import scale as S
from ..operators import select as SEL
from .registry import doc_labels, events_dirty, part_dirty, query, table, with_views
from .sqlgen import fences_cte, union_all

U_SQL = "CAST(('0x' || substr(md5('42:' || CAST({k} AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0"


def _ev(spark, sf):
    return events_dirty(spark, sf).select("event_id", "user_id", "event_type", "value")


def _names(df):
    return df.sparkSession.createDataFrame([(c,) for c in df.columns], "column_name string")


# =========================================================================== joins / aggregations
@query("dimension_count_join",
       "SELECT n.n_nationkey, n.n_name, n.n_regionkey, CAST(coalesce(c.cnt, 0) AS BIGINT) AS n FROM nation n "
       "LEFT JOIN (SELECT c_nationkey, count(*) AS cnt FROM customer GROUP BY 1) c ON n.n_nationkey = c.c_nationkey")
def q_dimension_count_join(spark, sf):
    return R.dimension_count_join(table(spark, sf, "nation"), table(spark, sf, "customer"), "n_nationkey", "c_nationkey")


@query("top_category_semi_filter",
       "WITH top AS (SELECT p_brand FROM part GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 10) "
       "SELECT * FROM part WHERE p_brand IN (SELECT p_brand FROM top)")
def q_top_category_semi_filter(spark, sf):
    return R.top_category_semi_filter(table(spark, sf, "part"), "p_brand", 10)


@query("category_stat_lookup", with_views(
    "SELECT d.*, m.mean_price FROM part_dirty d LEFT JOIN (SELECT p_brand, avg(p_retailprice) AS mean_price "
    "FROM part_dirty WHERE p_brand IS NOT NULL GROUP BY 1) m ON d.p_brand = m.p_brand", "part_dirty"))
def q_category_stat_lookup(spark, sf):
    return R.category_stat_lookup(part_dirty(spark, sf), "p_brand", {"mean_price": F.avg("p_retailprice")})


@query("group_mean", "SELECT l_returnflag, avg(l_extendedprice) AS mean_l_extendedprice FROM lineitem GROUP BY 1")
def q_group_mean(spark, sf):
    return R.group_mean(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice")


@query("group_sum_count",
       'SELECT l_linestatus, sum(l_quantity) AS "sum", count(l_quantity) AS "count" FROM lineitem GROUP BY 1')
def q_group_sum_count(spark, sf):
    return R.group_sum_count(table(spark, sf, "lineitem"), "l_linestatus", "l_quantity")


@query("cluster_summary",
       "SELECT p_type, avg(p_size) AS p_size_mean, stddev_samp(p_size) AS p_size_std, count(p_size) AS p_size_count, "
       "avg(p_retailprice) AS p_retailprice_mean, stddev_samp(p_retailprice) AS p_retailprice_std, "
       "count(p_retailprice) AS p_retailprice_count FROM part GROUP BY p_type")
def q_cluster_summary(spark, sf):
    return R.cluster_summary(table(spark, sf, "part"), "p_type", ["p_size", "p_retailprice"])


@query("value_counts", with_views(
    "SELECT p_brand AS value, count(*) AS count, count(*) / (SELECT count(p_brand) FROM part_dirty) AS share "
    "FROM part_dirty WHERE p_brand IS NOT NULL GROUP BY 1", "part_dirty"))
def q_value_counts(spark, sf):
    return R.value_counts(part_dirty(spark, sf), "p_brand", normalize=True)


@query("distinct_count", with_views(union_all(
    [f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, "
     f"count(DISTINCT {c}) + max(CAST({c} IS NULL AS INT)) AS n_unique_with_null FROM part_dirty"
     for c in ["p_brand", "p_size", "p_type"]]), "part_dirty"))
def q_distinct_count(spark, sf):
    return R.distinct_count(part_dirty(spark, sf), ["p_brand", "p_size", "p_type"])


@query("sort_desc", "SELECT c_mktsegment AS value, count(*) AS count FROM customer GROUP BY 1")
def q_sort_desc(spark, sf):
    return R.sort_desc(R.value_counts(table(spark, sf, "customer"), "c_mktsegment"), "count", "value")


@query("top_k_values",
       "SELECT l_partkey AS value, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def q_top_k_values(spark, sf):
    return R.top_k_values(table(spark, sf, "lineitem"), "l_partkey", 15)


@query("top_k_per_group",
       "SELECT * FROM (SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice, row_number() OVER "
       "(PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank FROM lineitem) "
       "WHERE rank <= 3")
def q_top_k_per_group(spark, sf):
    df = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    return R.top_k_per_group(df, "l_returnflag", "l_extendedprice", 3, tie=["l_orderkey", "l_linenumber"])


@query("sample_n", f"SELECT * FROM part ORDER BY {U_SQL.format(k='p_partkey')}, p_partkey LIMIT 200")
def q_sample_n(spark, sf):
    return R.sample_n(table(spark, sf, "part"), 200, "p_partkey")


@query("sample_stratified",
       f"SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM (SELECT *, row_number() OVER "
       f"(PARTITION BY p_type ORDER BY {U_SQL.format(k='p_partkey')}, p_partkey) AS r, "
       "count(*) OVER (PARTITION BY p_type) AS n FROM part) WHERE r <= round(n * 0.1)")
def q_sample_stratified(spark, sf):
    return R.sample_stratified(table(spark, sf, "part"), "p_type", 0.1, "p_partkey")


@query("train_test_split",
       f"SELECT o_orderkey, o_totalprice, CASE WHEN {U_SQL.format(k='o_orderkey')} < 0.2 THEN 'test' ELSE 'train' END "
       "AS split FROM orders")
def q_train_test_split(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return R.hash_split_label(df, "o_orderkey", 0.2)


@query("union_all",
       "SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, count(*) AS count FROM orders GROUP BY 2 "
       "UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2")
def q_union_all(spark, sf):
    return R.stacked_value_counts(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("append_columns",
       "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem")
def q_append_columns(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    li = table(spark, sf, "lineitem")
    return R.append_columns(li.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount"),
                            {"revenue": F.col("l_extendedprice") * (1 - F.col("l_discount"))}
                            ).select(*df.columns, "revenue")


@query("explode_tags",
       "WITH t AS (SELECT trim(unnest(string_split(p_name, ' '))) AS tag FROM part) "
       "SELECT tag, count(*) AS count, count(*) / (SELECT count(*) FROM part) AS share FROM t WHERE tag <> '' GROUP BY 1")
def q_explode_tags(spark, sf):
    return R.explode_tags(table(spark, sf, "part"), "p_name", " ")


@query("rare_usage_share",
       "WITH c AS (SELECT l_partkey, count(*) AS c FROM lineitem GROUP BY 1), "
       "b AS (SELECT CASE WHEN c = 1 THEN 'once' WHEN c < 3 THEN '2-2' ELSE '>=3' END AS band FROM c) "
       "SELECT band, count(*) AS n_values, count(*) / (SELECT count(*) FROM c) AS share FROM b GROUP BY 1")
def q_rare_usage_share(spark, sf):
    return R.rare_usage_share(table(spark, sf, "lineitem"), "l_partkey", 3)


@query("cumulative_sum",
       "SELECT value, count, sum(count) OVER (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
       "AS cumulative FROM (SELECT o_orderpriority AS value, count(*) AS count FROM orders GROUP BY 1)")
def q_cumulative_sum(spark, sf):
    counts = R.value_counts(table(spark, sf, "orders"), "o_orderpriority")
    return R.cumulative_sum(counts, "value", "count").withColumn("cumulative", F.col("cumulative").cast("bigint"))


# =========================================================================== encoders
_KEEP_NAME = ("c AS (SELECT p_name AS v, count(*) AS n FROM part_dirty WHERE p_name IS NOT NULL GROUP BY 1), "
              "k AS (SELECT v FROM c WHERE n >= CAST(0.016 AS DOUBLE) * (SELECT sum(n) FROM c)) ")


@query("merge_rare", with_views(
    _KEEP_NAME + "SELECT p_partkey, CASE WHEN p_name IN (SELECT v FROM k) THEN p_name ELSE 'OTHER' END AS p_name "
    "FROM part_dirty", "part_dirty"))
def q_merge_rare(spark, sf):
    return E.merge_rare(part_dirty(spark, sf).select("p_partkey", "p_name"), ["p_name"], 0.016)


_TYPES = ["MEDIUM", "OTHER", "PROMO", "SMALL", "STANDARD"]


@query("onehot_drop_first",
       "WITH c AS (SELECT p_type AS v, count(*) AS n FROM part GROUP BY 1), "
       "k AS (SELECT v FROM c WHERE n >= CAST(0.16 AS DOUBLE) * (SELECT sum(n) FROM c)), "
       "m AS (SELECT p_partkey, CASE WHEN p_type IN (SELECT v FROM k) THEN p_type ELSE 'OTHER' END AS t FROM part) "
       "SELECT p_partkey, " + ", ".join(f"t = '{v}' AS p_type_{v}" for v in _TYPES) + " FROM m")
def q_onehot_drop_first(spark, sf):
    return E.onehot_drop_first(table(spark, sf, "part").select("p_partkey", "p_type"), ["p_type"], 0.16)


_ALL_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("onehot_full", "SELECT p_partkey, " + ", ".join(f"coalesce(p_type = '{v}', FALSE) AS p_type_{v}"
                                                       for v in _ALL_TYPES) + " FROM part")
def q_onehot_full(spark, sf):
    return E.onehot_full(table(spark, sf, "part").select("p_partkey", "p_type", "p_retailprice"), "p_retailprice")


@query("count_encode", with_views(
    "c AS (SELECT p_brand AS v, count(*) AS n FROM part_dirty WHERE p_brand IS NOT NULL GROUP BY 1), "
    "k AS (SELECT v FROM c WHERE n >= CAST(0.01 AS DOUBLE) * (SELECT sum(n) FROM c)), "
    "m AS (SELECT p_partkey, CASE WHEN p_brand IN (SELECT v FROM k) THEN p_brand ELSE 'OTHER' END AS p_brand "
    "FROM part_dirty) SELECT p_partkey, count(*) OVER (PARTITION BY p_brand) AS p_brand FROM m", "part_dirty"))
def q_count_encode(spark, sf):
    return E.count_encode(part_dirty(spark, sf).select("p_partkey", "p_brand"), ["p_brand"], 0.01)


@query("hash_encode", "SELECT p_partkey, " + ", ".join(
    f"CAST(CAST(('0x' || substr(md5(p_type), 25, 8)) AS BIGINT) % 8 = {i} AS INTEGER) AS p_type_{i}"
    for i in range(8)) + " FROM part")
def q_hash_encode(spark, sf):
    return E.hash_encode(table(spark, sf, "part").select("p_partkey", "p_type"), ["p_type"], 8)


_TSTATS = ("s AS (SELECT p_brand AS k, count(p_retailprice) AS n, sum(p_retailprice) AS sm, avg(p_retailprice) AS mn "
           "FROM part_dirty WHERE p_brand IS NOT NULL GROUP BY 1), pr AS (SELECT avg(p_retailprice) AS prior FROM part_dirty) ")


@query("target_encode", with_views(
    _TSTATS + "SELECT d.p_partkey, d.p_retailprice, CASE WHEN s.n > 1 THEN pr.prior * (1 - 1 / (1 + exp(-(s.n - 20) / 10.0))) "
    "+ s.mn * (1 / (1 + exp(-(s.n - 20) / 10.0))) ELSE pr.prior END AS p_brand "
    "FROM part_dirty d CROSS JOIN pr LEFT JOIN s ON d.p_brand = s.k", "part_dirty"))
def q_target_encode(spark, sf):
    return E.target_encode(part_dirty(spark, sf).select("p_partkey", "p_brand", "p_retailprice"), "p_brand",
                           "p_retailprice")


@query("mean_encode", with_views(
    _TSTATS + "SELECT d.p_partkey, d.p_retailprice, s.mn AS p_brand FROM part_dirty d LEFT JOIN s ON d.p_brand = s.k",
    "part_dirty"))
def q_mean_encode(spark, sf):
    return E.mean_encode(part_dirty(spark, sf).select("p_partkey", "p_brand", "p_retailprice"), "p_brand",
                         "p_retailprice")


@query("frequency_encode", with_views(
    "SELECT p_partkey, CASE WHEN p_brand IS NULL THEN NULL ELSE count(*) OVER (PARTITION BY p_brand) / "
    "(SELECT count(p_brand) FROM part_dirty) END AS p_brand FROM part_dirty", "part_dirty"))
def q_frequency_encode(spark, sf):
    return E.frequency_encode(part_dirty(spark, sf).select("p_partkey", "p_brand"), "p_brand")


@query("leave_one_out_encode", with_views(
    _TSTATS + "SELECT d.p_partkey, d.p_retailprice, coalesce(CASE WHEN s.n > 1 AND d.p_retailprice IS NOT NULL "
    "THEN (s.sm - d.p_retailprice) / (s.n - 1) END, pr.prior) AS p_brand "
    "FROM part_dirty d CROSS JOIN pr LEFT JOIN s ON d.p_brand = s.k", "part_dirty"))
def q_leave_one_out_encode(spark, sf):
    return E.leave_one_out_encode(part_dirty(spark, sf).select("p_partkey", "p_brand", "p_retailprice"), "p_brand",
                                  "p_retailprice")


@query("woe_encode", with_views(
    "s AS (SELECT lang AS k, count(quality) AS n, sum(quality) AS sm FROM doc_labels GROUP BY 1) "
    "SELECT d.doc_id, d.quality, ln((s.sm + 0.5) / (s.n - s.sm + 0.5)) AS lang FROM doc_labels d "
    "LEFT JOIN s ON d.lang = s.k", "doc_labels"))
def q_woe_encode(spark, sf):
    return E.woe_encode(doc_labels(spark, sf).select("doc_id", "lang", "quality"), "lang", "quality")


@query("cluster_categories")
def q_cluster_categories(spark, sf):
    return E.cluster_categories(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
                                .withColumn("l_partkey", F.col("l_partkey").cast("string")), "l_partkey", 5)


@query("encoding_selected", "SELECT p_partkey, p_retailprice, avg(p_retailprice) OVER (PARTITION BY p_type) AS p_type "
       "FROM part")
def q_encoding_selected(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_type", "p_retailprice")
    return E.encoding_selected(df, "mean", col="p_type", target="p_retailprice")


# =========================================================================== outliers
_EV = "event_id, user_id, event_type, value"


@query("tukey_flag", with_views(
    fences_cte("events_dirty", "value") + f" SELECT {_EV}, CAST(coalesce(value < f.lo OR value > f.hi, FALSE) AS INT) "
    "AS outlier_tukey_value FROM events_dirty, f", "events_dirty"))
def q_tukey_flag(spark, sf):
    return O.tukey_flag(_ev(spark, sf), "value")


_ZS = "z AS (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events_dirty) "


@query("zscore_flag", with_views(
    _ZS + f"SELECT {_EV}, CAST(coalesce(abs((value - z.m) / z.s) > 3, FALSE) AS INT) AS outlier_zscore_value "
    "FROM events_dirty, z", "events_dirty"))
def q_zscore_flag(spark, sf):
    return O.zscore_flag(_ev(spark, sf), "value")


@query("outlier_summary", with_views(
    fences_cte("events_dirty", "value") + ", " + _ZS +
    "SELECT 'value' AS column_name, count_if(value < f.lo OR value > f.hi) AS n_tukey, "
    "count_if(abs((value - z.m) / z.s) > 3) AS n_zscore FROM events_dirty, f, z", "events_dirty"))
def q_outlier_summary(spark, sf):
    return O.outlier_summary(_ev(spark, sf), "value")


@query("outlier_treatment", with_views(
    fences_cte("events_dirty", "value") + ", md AS (SELECT quantile_cont(value, 0.5) AS med FROM events_dirty) "
    "SELECT event_id, user_id, event_type, CASE WHEN coalesce(value < f.lo OR value > f.hi, FALSE) THEN md.med "
    "ELSE value END AS value FROM events_dirty, f, md", "events_dirty"))
def q_outlier_treatment(spark, sf):
    return O.handle_outliers(_ev(spark, sf), "value", "impute_median")


@query("outlier_analysis", with_views(
    fences_cte("events_dirty", "value", "f1") + ", "
    f"s1 AS (SELECT {_EV} FROM events_dirty, f1 WHERE NOT coalesce(value < f1.lo OR value > f1.hi, FALSE)), "
    + fences_cte("s1", "user_id", "f2") +
    f" SELECT {_EV} FROM s1, f2 WHERE NOT coalesce(user_id < f2.lo OR user_id > f2.hi, FALSE)", "events_dirty"))
def q_outlier_analysis(spark, sf):
    treated, _summary = O.outlier_analysis(_ev(spark, sf), ["value", "user_id"], "remove")
    return treated


@query("outlier_analysis_summary")
def q_outlier_analysis_summary(spark, sf):
    _treated, summary = O.outlier_analysis(_ev(spark, sf), ["value", "user_id"], "remove", key="event_id")
    return summary


@query("outlier_scatter_data", with_views(
    fences_cte("events_dirty", "value") + " SELECT event_id, value, CAST(coalesce(value < f.lo OR value > f.hi, FALSE) "
    "AS INT) AS is_outlier FROM events_dirty, f", "events_dirty"))
def q_outlier_scatter_data(spark, sf):
    return O.outlier_scatter_data(_ev(spark, sf), "event_id", "value")


# =========================================================================== scaling
def _pd2(spark, sf):
    return part_dirty(spark, sf).select("p_partkey", "p_size", "p_retailprice")


def _scale_sql(expr_for):
    cols = ["p_size", "p_retailprice"]
    stats = ", ".join(
        f"avg(coalesce({c}, 0)) AS {c}_m0, stddev_pop(coalesce({c}, 0)) AS {c}_sp0, min(coalesce({c}, 0)) AS {c}_lo0, "
        f"max(coalesce({c}, 0)) AS {c}_hi0, avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_ss, min({c}) AS {c}_lo, "
        f"max({c}) AS {c}_hi, quantile_cont(coalesce({c}, 0), [0.25, 0.5, 0.75]) AS {c}_q0, "
        f"quantile_cont({c}, [0.25, 0.5, 0.75]) AS {c}_q" for c in cols)
    body = ", ".join(f"{expr_for(c)} AS {c}" for c in cols)
    return with_views(f"st AS (SELECT {stats} FROM part_dirty) SELECT p_partkey, {body} FROM part_dirty, st",
                      "part_dirty")


@query("scale_standard", _scale_sql(lambda c: f"(coalesce({c}, 0) - {c}_m0) / CASE WHEN {c}_sp0 = 0 THEN 1 ELSE {c}_sp0 END"))
def q_scale_standard(spark, sf):
    return S.scale_standard(_pd2(spark, sf), ["p_size", "p_retailprice"])


@query("scale_standard_sample", _scale_sql(lambda c: f"CASE WHEN {c}_ss > 0 THEN ({c} - {c}_m) / {c}_ss ELSE {c} END"))
def q_scale_standard_sample(spark, sf):
    return S.scale_standard_sample(_pd2(spark, sf), ["p_size", "p_retailprice"])


@query("scale_minmax", _scale_sql(
    lambda c: f"(coalesce({c}, 0) - {c}_lo0) / CASE WHEN {c}_hi0 - {c}_lo0 > 0 THEN {c}_hi0 - {c}_lo0 ELSE 1 END"))
def q_scale_minmax(spark, sf):
    return S.scale_minmax(_pd2(spark, sf), ["p_size", "p_retailprice"])


@query("scale_minmax_true", _scale_sql(
    lambda c: f"CASE WHEN {c}_hi - {c}_lo > 0 THEN ({c} - {c}_lo) / ({c}_hi - {c}_lo) ELSE {c} END"))
def q_scale_minmax_true(spark, sf):
    return S.scale_minmax_true(_pd2(spark, sf), ["p_size", "p_retailprice"])


@query("scale_robust", _scale_sql(
    lambda c: f"(coalesce({c}, 0) - {c}_q0[2]) / CASE WHEN {c}_q0[3] - {c}_q0[1] <> 0 THEN {c}_q0[3] - {c}_q0[1] ELSE 1 END"))
def q_scale_robust(spark, sf):
    return S.scale_robust(_pd2(spark, sf), ["p_size", "p_retailprice"])


@query("scale_robust_true", _scale_sql(
    lambda c: f"CASE WHEN {c}_q[3] - {c}_q[1] > 0 THEN ({c} - {c}_q[2]) / ({c}_q[3] - {c}_q[1]) ELSE {c} END"))
def q_scale_robust_true(spark, sf):
    return S.scale_robust_true(_pd2(spark, sf), ["p_size", "p_retailprice"])


@query("scale_generic", _scale_sql(
    lambda c: f"(coalesce({c}, 0) - {c}_lo0) / CASE WHEN {c}_hi0 - {c}_lo0 > 0 THEN {c}_hi0 - {c}_lo0 ELSE 1 END"))
def q_scale_generic(spark, sf):
    return S.scale_generic(_pd2(spark, sf), "minmax", ["p_size", "p_retailprice"])


def _scale_auto_sql():
    cols = ["value", "user_id", "event_id"]
    st = ", ".join(
        f"skewness({c}) AS {c}_g1, kurtosis({c}) AS {c}_g2, avg(coalesce({c}, 0)) AS {c}_m0, "
        f"stddev_pop(coalesce({c}, 0)) AS {c}_sp0, min(coalesce({c}, 0)) AS {c}_lo0, max(coalesce({c}, 0)) AS {c}_hi0, "
        f"quantile_cont(coalesce({c}, 0), [0.25, 0.5, 0.75]) AS {c}_q0" for c in cols)
    body = ", ".join(
        f"CASE WHEN abs({c}_g1) > 1 THEN (coalesce({c}, 0) - {c}_q0[2]) / CASE WHEN {c}_q0[3] - {c}_q0[1] <> 0 "
        f"THEN {c}_q0[3] - {c}_q0[1] ELSE 1 END "
        f"WHEN abs({c}_g2) < 3 THEN (coalesce({c}, 0) - {c}_lo0) / CASE WHEN {c}_hi0 - {c}_lo0 > 0 "
        f"THEN {c}_hi0 - {c}_lo0 ELSE 1 END "
        f"ELSE (coalesce({c}, 0) - {c}_m0) / CASE WHEN {c}_sp0 = 0 THEN 1 ELSE {c}_sp0 END END AS {c}" for c in cols)
    return with_views(f"st AS (SELECT {st} FROM events_dirty) SELECT event_type, {body} FROM events_dirty, st",
                      "events_dirty")


@query("scale_auto", _scale_auto_sql())
def q_scale_auto(spark, sf):
    return S.scale_auto(_ev(spark, sf), ["value", "user_id", "event_id"])


@query("normalize_l2_columns", _scale_sql(lambda c: f"{c} / (SELECT sqrt(sum(coalesce({c}, 0) * coalesce({c}, 0))) "
                                          "FROM part_dirty)"))
def q_normalize_l2_columns(spark, sf):
    return S.normalize_l2_columns(_pd2(spark, sf), ["p_size", "p_retailprice"])


@query("log1p_transform", with_views(
    "SELECT event_id, CASE WHEN 1 + coalesce(value, 0) > 0 THEN ln(1 + coalesce(value, 0)) END AS value "
    "FROM events_dirty", "events_dirty"))
def q_log1p_transform(spark, sf):
    return S.log1p_transform(_ev(spark, sf).select("event_id", "value"), ["value"])


# =========================================================================== imputation
@query("impute_mean", with_views(
    "SELECT p_partkey, p_type, coalesce(CAST(p_size AS DOUBLE), (SELECT avg(p_size) FROM part_dirty)) AS p_size, "
    "p_retailprice FROM part_dirty", "part_dirty"))
def q_impute_mean(spark, sf):
    return I.impute_mean(part_dirty(spark, sf).select("p_partkey", "p_type", "p_size", "p_retailprice"), ["p_size"])


@query("impute_median", with_views(
    "SELECT p_partkey, p_type, coalesce(CAST(p_size AS DOUBLE), (SELECT quantile_cont(p_size, 0.5) FROM part_dirty)) "
    "AS p_size, p_retailprice FROM part_dirty", "part_dirty"))
def q_impute_median(spark, sf):
    return I.impute_median(part_dirty(spark, sf).select("p_partkey", "p_type", "p_size", "p_retailprice"), ["p_size"])


@query("impute_mode", with_views(
    "SELECT p_partkey, coalesce(p_brand, (SELECT p_brand FROM part_dirty WHERE p_brand IS NOT NULL GROUP BY 1 "
    "ORDER BY count(*) DESC, 1 LIMIT 1)) AS p_brand, coalesce(CAST(p_size AS DOUBLE), (SELECT p_size FROM part_dirty "
    "WHERE p_size IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS p_size FROM part_dirty", "part_dirty"))
def q_impute_mode(spark, sf):
    return I.impute_mode(part_dirty(spark, sf).select("p_partkey", "p_brand", "p_size"))


@query("impute_drop", with_views("SELECT * FROM part_dirty WHERE p_brand IS NOT NULL AND p_size IS NOT NULL",
                                 "part_dirty"))
def q_impute_drop(spark, sf):
    return I.impute_drop(part_dirty(spark, sf))


@query("impute_cca", with_views("SELECT * FROM part_dirty WHERE p_brand IS NOT NULL", "part_dirty"))
def q_impute_cca(spark, sf):
    return I.impute_cca(part_dirty(spark, sf), "p_brand")


@query("impute_arbitrary", with_views(
    "SELECT p_partkey, coalesce(CAST(p_size AS DOUBLE), 0.0) AS p_size FROM part_dirty", "part_dirty"))
def q_impute_arbitrary(spark, sf):
    return I.impute_arbitrary(part_dirty(spark, sf).select("p_partkey", "p_size"), "p_size", 0)


@query("impute_mark", with_views(
    "SELECT p_partkey, coalesce(p_brand, 'Imputed') AS p_brand FROM part_dirty", "part_dirty"))
def q_impute_mark(spark, sf):
    return I.impute_mark(part_dirty(spark, sf).select("p_partkey", "p_brand"), "p_brand")


@query("impute_linear_regression", with_views(
    "r AS (SELECT regr_slope(p_size, p_retailprice) AS b, regr_intercept(p_size, p_retailprice) AS a FROM part_dirty) "
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, coalesce(CAST(p_size AS DOUBLE), r.a + r.b * p_retailprice) AS p_size, "
    "p_retailprice FROM part_dirty, r", "part_dirty"))
def q_impute_linear_regression(spark, sf):
    df = part_dirty(spark, sf).select(F.col("p_partkey").cast("string").alias("p_partkey"), "p_size", "p_retailprice")
    return I.impute_linear_regression(df, "p_size")


@query("impute_from_ratio_mean", with_views(
    "r AS (SELECT avg(p_retailprice / p_size) AS ratio FROM part_dirty WHERE p_size <> 0) "
    "SELECT p_partkey, p_retailprice, coalesce(CAST(p_size AS DOUBLE), p_retailprice / r.ratio) AS p_size "
    "FROM part_dirty, r", "part_dirty"))
def q_impute_from_ratio_mean(spark, sf):
    return I.impute_from_ratio_mean(part_dirty(spark, sf).select("p_partkey", "p_retailprice", "p_size"),
                                    "p_retailprice", "p_size")


@query("impute_from_ratio_of_means", with_views(
    "r AS (SELECT avg(p_retailprice) / avg(p_size) AS ratio FROM part_dirty) "
    "SELECT p_partkey, p_retailprice, coalesce(CAST(p_size AS DOUBLE), p_retailprice / r.ratio) AS p_size "
    "FROM part_dirty, r", "part_dirty"))
def q_impute_from_ratio_of_means(spark, sf):
    return I.impute_from_ratio_of_means(part_dirty(spark, sf).select("p_partkey", "p_retailprice", "p_size"),
                                        "p_retailprice", "p_size")


@query("impute_group_mean", with_views(
    "g AS (SELECT p_type AS k, avg(p_size) AS m FROM part_dirty GROUP BY 1 HAVING count(*) >= 2) "
    "SELECT d.p_partkey, d.p_type, coalesce(CAST(d.p_size AS DOUBLE), g.m) AS p_size FROM part_dirty d "
    "LEFT JOIN g ON d.p_type = g.k", "part_dirty"))
def q_impute_group_mean(spark, sf):
    return I.impute_group_mean(part_dirty(spark, sf).select("p_partkey", "p_type", "p_size"), "p_size", "p_type")


@query("impute_missing_values", with_views(
    "SELECT p_partkey, p_type, p_brand, coalesce(CAST(p_size AS DOUBLE), (SELECT quantile_cont(p_size, 0.5) "
    "FROM part_dirty)) AS p_size, p_retailprice FROM part_dirty", "part_dirty"))
def q_impute_missing_values(spark, sf):
    df = part_dirty(spark, sf).select("p_partkey", "p_type", "p_brand", "p_size", "p_retailprice")
    return I.impute_missing_values(df, "median", cols=["p_size"])


# =========================================================================== column selection
_LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _li(spark, sf):
    return table(spark, sf, "lineitem").select(*_LI)


@query("correlation_matrix", union_all(
    [f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS corr FROM lineitem" for a in _LI for b in _LI]))
def q_correlation_matrix(spark, sf):
    return SEL.correlation_matrix(_li(spark, sf))


def _kept_sql(cond_for, cols=_LI, src="lineitem"):
    return union_all([f"SELECT '{c}' AS column_name FROM {src} HAVING {cond_for(c)}" for c in cols])


def _any_corr(c, thr, cols=_LI):
    return " OR ".join(f"coalesce(abs(corr({c}, {o})) >= {thr}, FALSE)" for o in cols if o != c)


@query("drop_low_correlation", _kept_sql(lambda c: _any_corr(c, 0.1)))
def q_drop_low_correlation(spark, sf):
    return _names(SEL.drop_low_correlation(_li(spark, sf), 0.1))


def _high_corr_kept(c):
    earlier = _LI[:_LI.index(c)]
    if not earlier:
        return "TRUE"
    return "NOT (" + " OR ".join(f"coalesce(abs(corr({a}, {c})) > 0.5, FALSE)" for a in earlier) + ")"


@query("drop_high_correlation", _kept_sql(_high_corr_kept))
def q_drop_high_correlation(spark, sf):
    return _names(SEL.drop_high_correlation(_li(spark, sf), 0.5))


@query("drop_sparse_columns", with_views(_kept_sql(
    lambda c: f"count_if({c} IS NULL) / count(*) <= 0.12",
    ["p_partkey", "p_type", "p_brand", "p_name", "p_size", "p_retailprice"], "part_dirty"), "part_dirty"))
def q_drop_sparse_columns(spark, sf):
    return _names(SEL.drop_sparse_columns(part_dirty(spark, sf), 0.12))


@query("drop_low_variance", _kept_sql(lambda c: f"var_pop({c}) >= 0.1"))
def q_drop_low_variance(spark, sf):
    return _names(SEL.drop_low_variance(_li(spark, sf), 0.1))


_CORR_PK_PRICE = "coalesce(abs(corr(p_partkey, p_retailprice)) >= 0.1, FALSE)"


@query("filter_irrelevant_columns", with_views(union_all([
    f"SELECT 'p_partkey' AS column_name FROM part_dirty HAVING var_pop(p_partkey) >= 0.1 AND {_CORR_PK_PRICE}",
    f"SELECT 'p_retailprice' FROM part_dirty HAVING var_pop(p_retailprice) >= 0.1 AND {_CORR_PK_PRICE}",
    "SELECT 'p_size' FROM part_dirty HAVING var_pop(p_size) >= 0.1 AND count_if(p_size IS NULL) / count(*) <= 0.12 "
    "AND (coalesce(abs(corr(p_size, p_partkey)) >= 0.1, FALSE) OR coalesce(abs(corr(p_size, p_retailprice)) >= 0.1, FALSE))",
]), "part_dirty"))
def q_filter_irrelevant_columns(spark, sf):
    df = part_dirty(spark, sf).select("p_partkey", "p_size", "p_retailprice")
    return _names(SEL.filter_irrelevant_columns(df, ["variance", "missing", "correlation"], 0.1, 0.12, 0.1))

