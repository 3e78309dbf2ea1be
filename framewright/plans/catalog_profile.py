"""Registered queries: column typing and profiling (2.2)."""

from __future__ import annotations


from ..operators import profile as P
from ..operators.relational import sample_n
from .registry import events_dirty, part_dirty, query, table, with_views
from .sqlgen import big, union_all

EVN = ["event_id", "user_id", "value"]


def _ev(spark, sf):
    return events_dirty(spark, sf).select("event_id", "user_id", "event_type", "value")


def _classify_sql():
    parts = []
    for c in ["p_name", "p_brand", "p_type"]:
        parts.append(f"SELECT '{c}' AS column_name, CASE WHEN count(DISTINCT {c}) <= 10 THEN 'ordinal' "
                     f"ELSE 'nominal' END AS kind, count(DISTINCT {c}) AS n_distinct FROM part")
    for c in ["p_partkey", "p_size", "p_retailprice"]:
        parts.append(f"SELECT '{c}' AS column_name, 'numeric' AS kind, CAST(NULL AS BIGINT) AS n_distinct")
    return union_all(parts)


@query("classify_columns", _classify_sql())
def q_classify_columns(spark, sf):
    return P.classify_columns(table(spark, sf, "part"))


@query("filter_by_category_count", "SELECT p_partkey, p_size, p_retailprice, p_name, p_brand FROM part")
def q_filter_by_category_count(spark, sf):
    return P.filter_by_category_count(table(spark, sf, "part"), min_categories=10)


_PD3 = "p_type, p_brand, p_size"


@query("table_summary", with_views(
    "SELECT count(*) AS n_rows, CAST(3 AS BIGINT) AS n_columns, "
    + big("sum(CAST(p_type IS NULL AS INT) + CAST(p_brand IS NULL AS INT) + CAST(p_size IS NULL AS INT))")
    + " AS n_null_cells, (SELECT " + big("coalesce(sum(c - 1), 0)")
    + f" FROM (SELECT count(*) AS c FROM part_dirty GROUP BY {_PD3})) AS n_duplicates FROM part_dirty",
    "part_dirty"))
def q_table_summary(spark, sf):
    return P.table_summary(part_dirty(spark, sf).select("p_type", "p_brand", "p_size"))


@query("null_counts", with_views(union_all(
    [f"SELECT '{c}' AS column_name, count_if({c} IS NULL) AS n_null FROM events_dirty HAVING count_if({c} IS NULL) > 0"
     for c in ["event_id", "user_id", "event_type", "value"]]), "events_dirty"))
def q_null_counts(spark, sf):
    return P.null_counts(_ev(spark, sf))


@query("duplicate_row_count", with_views(
    "SELECT " + big("coalesce(sum(c - 1), 0)") + f" AS n_duplicates FROM (SELECT count(*) AS c FROM part_dirty "
    f"GROUP BY {_PD3})", "part_dirty"))
def q_duplicate_row_count(spark, sf):
    return P.duplicate_row_count(part_dirty(spark, sf).select("p_type", "p_brand", "p_size"))


@query("negative_values", with_views(union_all(
    [f"SELECT '{c}' AS column_name, count_if({c} < 0) AS n_negative FROM events_dirty HAVING count_if({c} < 0) > 0"
     for c in EVN]), "events_dirty"))
def q_negative_values(spark, sf):
    return P.negative_values(_ev(spark, sf))


def _error_report_sql():
    parts = [f"SELECT 'missing_values' AS error_type, '{c}' AS column_name, count_if({c} IS NULL) AS n "
             f"FROM events_dirty HAVING count_if({c} IS NULL) > 0" for c in ["event_id", "user_id", "event_type", "value"]]
    parts.append("SELECT 'duplicate_rows', CAST(NULL AS VARCHAR), " + big("sum(c - 1)")
                 + " FROM (SELECT count(*) AS c FROM events_dirty GROUP BY event_id, user_id, event_type, value) "
                 "HAVING sum(c - 1) > 0")
    for c in EVN:
        parts.append(f"SELECT 'outliers', '{c}', count(*) FROM events_dirty, (SELECT quantile_cont({c}, 0.25) AS q1, "
                     f"quantile_cont({c}, 0.75) AS q3 FROM events_dirty) f "
                     f"WHERE {c} < f.q1 - 1.5 * (f.q3 - f.q1) OR {c} > f.q3 + 1.5 * (f.q3 - f.q1) HAVING count(*) > 0")
    parts += [f"SELECT 'inconsistent_values', '{c}', count_if({c} < 0) FROM events_dirty HAVING count_if({c} < 0) > 0"
              for c in EVN]
    return with_views(union_all(parts), "events_dirty")


@query("error_report", _error_report_sql())
def q_error_report(spark, sf):
    return P.error_report(_ev(spark, sf))


@query("describe_column", with_views(
    "SELECT count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, "
    "quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75, "
    "max(value) AS max, count_if(value IS NULL) AS n_null FROM events_dirty", "events_dirty"))
def q_describe_column(spark, sf):
    return P.describe_column(_ev(spark, sf), "value")


def _schema_info_sql():
    parts = []
    for c in ["p_partkey", "p_type", "p_brand", "p_name", "p_size", "p_retailprice"]:
        parts.append(f"SELECT '{c}' AS column_name, replace(replace(lower(typeof(any_value({c}))), 'varchar', 'string'), "
                     f"'integer', 'int') AS dtype, count({c}) AS non_null FROM part_dirty")
    return with_views(union_all(parts), "part_dirty")


@query("schema_info", _schema_info_sql())
def q_schema_info(spark, sf):
    return P.schema_info(part_dirty(spark, sf))


def _moments(c, src):
    n = f"CAST(count({c}) AS DOUBLE)"
    g1 = f"(skewness({c}) * ({n} - 2) / sqrt({n} * ({n} - 1)))"
    return n, g1, f"kurtosis_pop({c})"


def _numeric_profile_sql():
    parts = []
    for c in EVN:
        n, g1, g2 = _moments(c, "events_dirty")
        parts.append(f"SELECT '{c}' AS column_name, count({c}) AS n, avg({c}) AS mean, "
                     f"CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS median, stddev_samp({c}) AS std, "
                     f"{g1} AS skewness, {g2} AS kurtosis FROM events_dirty")
    return with_views(union_all(parts), "events_dirty")


@query("numeric_profile", _numeric_profile_sql())
def q_numeric_profile(spark, sf):
    return P.numeric_profile(_ev(spark, sf), EVN)


def _normality_sql():
    parts = []
    for c in ["value", "user_id"]:
        n, g1, g2 = _moments(c, "events_dirty")
        parts.append(f"SELECT '{c}' AS column_name, {n} AS n, {g1} AS g1, {g2} AS g2 FROM events_dirty")
    m = union_all(parts)
    return with_views(
        f"m AS ({m}), "
        "a AS (SELECT column_name, n, g2, g1 * sqrt((n + 1) * (n + 3) / (6.0 * (n - 2))) AS y0, "
        "3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS beta2, "
        "3.0 * (n - 1) / (n + 1) AS e, 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5)) AS var, "
        "6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb1 "
        "FROM m), "
        "b AS (SELECT *, CASE WHEN y0 = 0 THEN 1.0 ELSE y0 END AS y, -1 + sqrt(2 * (beta2 - 1)) AS w2, "
        "(g2 + 3 - e) / sqrt(var) AS x, 6.0 + 8.0 / sb1 * (2.0 / sb1 + sqrt(1 + 4.0 / (sb1 * sb1))) AS aa FROM a), "
        "c AS (SELECT *, 1 / sqrt(0.5 * ln(w2)) AS delta, sqrt(2 / (w2 - 1)) AS alpha, "
        "1 + x * sqrt(2 / (aa - 4.0)) AS den FROM b), "
        "d AS (SELECT column_name, delta * ln(y / alpha + sqrt((y / alpha) * (y / alpha) + 1)) AS zs, "
        "((1 - 2 / (9.0 * aa)) - sign(den) * pow((1 - 2.0 / aa) / abs(den), 1.0 / 3)) / sqrt(2 / (9.0 * aa)) AS zk "
        "FROM c) "
        "SELECT column_name, zs AS z_skew, zk AS z_kurtosis, zs * zs + zk * zk AS statistic, "
        "exp(-(zs * zs + zk * zk) / 2) AS p_value FROM d", "events_dirty")


@query("normality_test", _normality_sql())
def q_normality_test(spark, sf):
    return P.normality_test(_ev(spark, sf), ["value", "user_id"])


@query("skew_kurtosis_table", with_views(union_all(
    [f"SELECT '{c}' AS column_name, skewness({c}) AS skew, kurtosis({c}) AS kurtosis FROM events_dirty" for c in EVN]),
    "events_dirty"))
def q_skew_kurtosis_table(spark, sf):
    return P.skew_kurtosis_table(_ev(spark, sf), EVN)


@query("categorical_profile",
       "SELECT p_brand AS value, count(*) AS count, (SELECT count(DISTINCT p_brand) FROM part) AS n_distinct "
       "FROM part GROUP BY p_brand")
def q_categorical_profile(spark, sf):
    return P.categorical_profile(table(spark, sf, "part"), "p_brand")


@query("countplot_data", "SELECT p_type AS value, count(*) AS count FROM part GROUP BY p_type")
def q_countplot_data(spark, sf):
    return P.countplot_data(table(spark, sf, "part"), "p_type")


@query("histogram_bins",
       "WITH m AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS n FROM events), "
       "w AS (SELECT lo, n, (hi - lo) / 30 AS width FROM m), "
       "c AS (SELECT CAST(least(floor((value - w.lo) / w.width), 29) AS INTEGER) AS bin, count(*) AS cnt "
       "FROM events, w GROUP BY 1), g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(30)) "
       "SELECT g.bin, w.lo + g.bin * w.width AS lower, w.lo + (g.bin + 1) * w.width AS upper, "
       "CAST(coalesce(c.cnt, 0) AS BIGINT) AS count, coalesce(c.cnt, 0) / (w.n * w.width) AS density "
       "FROM g CROSS JOIN w LEFT JOIN c ON g.bin = c.bin")
def q_histogram_bins(spark, sf):
    return P.histogram_bins(table(spark, sf, "events"), "value", 30)


def _boxplot_sql():
    parts = []
    for c in ["value", "user_id"]:
        parts.append(
            f"SELECT '{c}' AS column_name, q1, med AS median, q3, "
            f"(SELECT min({c}) FROM events_dirty WHERE {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low, "
            f"(SELECT max({c}) FROM events_dirty WHERE {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high, "
            f"(SELECT count(*) FROM events_dirty WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers "
            f"FROM (SELECT CAST(quantile_cont({c}, 0.25) AS DOUBLE) AS q1, CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS med, "
            f"CAST(quantile_cont({c}, 0.75) AS DOUBLE) AS q3 FROM events_dirty)")
    return with_views(union_all(parts), "events_dirty")


@query("boxplot_stats", _boxplot_sql())
def q_boxplot_stats(spark, sf):
    return P.boxplot_stats(_ev(spark, sf), ["value", "user_id"])


@query("distribution_compare",
       "WITH s AS (SELECT * FROM part ORDER BY CAST(('0x' || substr(md5('42:' || CAST(p_partkey AS VARCHAR)), 1, 8)) "
       "AS BIGINT) / 4294967296.0, p_partkey LIMIT 200), "
       "top AS (SELECT p_brand FROM part GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 10) "
       "SELECT p_brand AS bucket, count(*) AS count, 'table' AS source FROM part WHERE p_brand IN (SELECT p_brand FROM top) "
       "GROUP BY p_brand UNION ALL SELECT p_brand, count(*), 'sample' FROM s WHERE p_brand IN (SELECT p_brand FROM top) "
       "GROUP BY p_brand")
def q_distribution_compare(spark, sf):
    part = table(spark, sf, "part")
    return P.distribution_compare(part, sample_n(part, 200, "p_partkey"), "p_brand", kind="categorical")


@query("filling_percentage", with_views(union_all(
    [f"SELECT '{c}' AS column_name, count({c}) * 100.0 / count(*) AS filled_pct FROM events_dirty"
     for c in ["event_id", "user_id", "event_type", "value"]]), "events_dirty"))
def q_filling_percentage(spark, sf):
    return P.filling_percentage(_ev(spark, sf))


@query("filling_band", with_views(
    "SELECT * FROM (" + union_all(
        [f"SELECT '{c}' AS column_name, count({c}) * 100.0 / count(*) AS filled_pct FROM events_dirty"
         for c in ["event_id", "user_id", "event_type", "value"]]) + ") WHERE filled_pct >= 50 AND filled_pct < 95",
    "events_dirty"))
def q_filling_band(spark, sf):
    return P.filling_band(_ev(spark, sf), 50.0, 95.0)


