"""Registered queries: sources, row cleaning and the notebook's cleaning funnel (2.1, 2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stats import qcol
from ..operators import clean as C
from ..sources.readers import row_limit, scan_parquet
from .registry import events_dirty, part_dirty, query, table, with_views
from .sqlgen import fences_cte, union_all

EV = "event_id, user_id, event_type, value"


def _ev(spark, sf):
    return events_dirty(spark, sf).select("event_id", "user_id", "event_type", "value")


# --------------------------------------------------------------------------- flagship
def events_clean_summary_df(spark, sf):
    """Minimum slice of the notebook cleaning: sentinel to null, bounds to null, IQR
    removal on the value, rows without a category dropped, per-category summary."""
    df = _ev(spark, sf)
    df = C.value_to_null(df, ["event_type"], "unknown")
    df = C.bounds_to_null_all(df, ["value"], 0.0, 500.0)
    df = C.iqr_remove(df, ["value"])
    df = df.where(F.col("event_type").isNotNull())
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"),
                                        F.stddev_samp("value").alias("std_value"), F.min("value").alias("min_value"),
                                        F.max("value").alias("max_value"))


query("events_clean_summary", with_views(
    "s1 AS (SELECT event_id, NULLIF(event_type, 'unknown') AS event_type, "
    "CASE WHEN value BETWEEN 0 AND 500 THEN value END AS value FROM events_dirty), "
    + fences_cte("s1", "value") + ", "
    "s2 AS (SELECT s1.* FROM s1, f WHERE value BETWEEN f.lo AND f.hi) "
    "SELECT event_type, count(*) AS n, avg(value) AS mean_value, stddev_samp(value) AS std_value, "
    "min(value) AS min_value, max(value) AS max_value FROM s2 WHERE event_type IS NOT NULL GROUP BY event_type",
    "events_dirty"))(events_clean_summary_df)


# --------------------------------------------------------------------------- sources
@query("scan_parquet", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem "
       "WHERE l_quantity >= 45")
def q_scan_parquet(spark, sf):
    return scan_parquet(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"],
                        where={"l_quantity": (45, None)})


@query("row_limit_load", "SELECT * FROM customer ORDER BY c_custkey LIMIT 1000")
def q_row_limit(spark, sf):
    return row_limit(table(spark, sf, "customer"), 1000, order_by=["c_custkey"])


# --------------------------------------------------------------------------- IQR family
@query("iqr_outlier_rows", with_views(
    fences_cte("events_dirty", "value") +
    f" SELECT {EV}, 'value' AS column_name FROM events_dirty, f WHERE value < f.lo OR value > f.hi",
    "events_dirty"))
def q_iqr_outlier_rows(spark, sf):
    return C.iqr_outlier_rows(_ev(spark, sf), ["value"])


@query("iqr_remove", with_views(
    fences_cte("events_dirty", "value", "f1") + ", "
    f"s1 AS (SELECT {EV} FROM events_dirty, f1 WHERE value BETWEEN f1.lo AND f1.hi), "
    + fences_cte("s1", "user_id", "f2") +
    f" SELECT {EV} FROM s1, f2 WHERE user_id BETWEEN f2.lo AND f2.hi",
    "events_dirty"))
def q_iqr_remove(spark, sf):
    return C.iqr_remove(_ev(spark, sf), ["value", "user_id"])


@query("iqr_clip", with_views(
    fences_cte("events_dirty", "value") +
    " SELECT event_id, user_id, event_type, CASE WHEN value < f.lo THEN f.lo WHEN value > f.hi THEN f.hi "
    "ELSE value END AS value FROM events_dirty, f", "events_dirty"))
def q_iqr_clip(spark, sf):
    return C.iqr_clip(_ev(spark, sf), ["value"])


@query("iqr_row_mask", with_views(
    fences_cte("events_dirty", "value", "f1") + ", " + fences_cte("events_dirty", "user_id", "f2") +
    f" SELECT {EV} FROM events_dirty, f1, f2 WHERE (value IS NULL OR value BETWEEN f1.lo AND f1.hi) "
    "AND (user_id BETWEEN f2.lo AND f2.hi)", "events_dirty"))
def q_iqr_row_mask(spark, sf):
    return C.iqr_row_mask(_ev(spark, sf), ["value", "user_id"])


# --------------------------------------------------------------------------- value rules
@query("abs_correct", with_views("SELECT event_id, user_id, event_type, abs(value) AS value FROM events_dirty",
                                 "events_dirty"))
def q_abs_correct(spark, sf):
    return C.abs_correct(_ev(spark, sf), ["value"])


@query("range_validate", with_views(
    "SELECT event_id, user_id, event_type, CASE WHEN value BETWEEN 0 AND 100 THEN value END AS value "
    "FROM events_dirty", "events_dirty"))
def q_range_validate(spark, sf):
    return C.range_validate(_ev(spark, sf), {"value": (0, 100)})


@query("drop_duplicates", with_views("SELECT DISTINCT p_type, p_size FROM part_dirty", "part_dirty"))
def q_drop_duplicates(spark, sf):
    return C.drop_duplicates(part_dirty(spark, sf).select("p_type", "p_size"))


@query("threshold_to_null", with_views(
    "SELECT event_id, user_id, event_type, CASE WHEN value > 400 THEN NULL ELSE value END AS value "
    "FROM events_dirty", "events_dirty"))
def q_threshold_to_null(spark, sf):
    return C.threshold_to_null(_ev(spark, sf), "value", 400.0)


@query("bounds_to_null_all", with_views(
    "SELECT event_id, event_type, CASE WHEN value BETWEEN 0 AND 100 THEN value END AS value, "
    "CASE WHEN CAST(user_id AS DOUBLE) BETWEEN 0 AND 100 THEN CAST(user_id AS DOUBLE) END AS user_id "
    "FROM events_dirty", "events_dirty"))
def q_bounds_to_null_all(spark, sf):
    return C.bounds_to_null_all(_ev(spark, sf), ["value", "user_id"], 0.0, 100.0)


@query("horizontal_sum_filter",
       "SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem "
       "WHERE l_quantity + l_discount + l_tax BETWEEN 0 AND 25")
def q_horizontal_sum_filter(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return C.horizontal_sum_filter(df, ["l_quantity", "l_discount", "l_tax"], 0.0, 25.0)


@query("horizontal_missing_filter", with_views(
    "SELECT * FROM part_dirty WHERE CAST(p_brand IS NULL AS INT) + CAST(p_size IS NULL AS INT) < 1", "part_dirty"))
def q_horizontal_missing_filter(spark, sf):
    return C.horizontal_missing_filter(part_dirty(spark, sf), ["p_brand", "p_size"], 1)


@query("missing_count_distribution", with_views(
    "SELECT CAST(p_brand IS NULL AS INT) + CAST(p_size IS NULL AS INT) AS n_missing, count(*) AS n_rows "
    "FROM part_dirty GROUP BY 1", "part_dirty"))
def q_missing_count_distribution(spark, sf):
    return C.missing_count_distribution(part_dirty(spark, sf), ["p_brand", "p_size"])


@query("drop_all_null_rows", with_views(
    f"SELECT {EV} FROM events_dirty WHERE event_type IS NOT NULL OR value IS NOT NULL", "events_dirty"))
def q_drop_all_null_rows(spark, sf):
    return C.drop_all_null_rows(_ev(spark, sf), ["event_type", "value"])


@query("drop_any_null_rows", with_views(
    f"SELECT {EV} FROM events_dirty WHERE event_type IS NOT NULL AND value IS NOT NULL", "events_dirty"))
def q_drop_any_null_rows(spark, sf):
    return C.drop_any_null_rows(_ev(spark, sf))


@query("blank_string_filter", with_views(
    "SELECT * FROM part_dirty WHERE p_name IS NOT NULL AND NOT regexp_matches(p_name, '^\\s*$')", "part_dirty"))
def q_blank_string_filter(spark, sf):
    return C.blank_string_filter(part_dirty(spark, sf), "p_name")


@query("either_present_filter", with_views(
    f"SELECT {EV} FROM events_dirty WHERE event_type IS NOT NULL OR value IS NOT NULL", "events_dirty"))
def q_either_present_filter(spark, sf):
    return C.either_present_filter(_ev(spark, sf), "event_type", "value")


@query("only_in_a_count", with_views(
    "SELECT count_if(event_type IS NOT NULL AND value IS NULL) AS n_only_a FROM events_dirty", "events_dirty"))
def q_only_in_a_count(spark, sf):
    return C.only_in_a_count(_ev(spark, sf), "event_type", "value")


@query("value_to_null", with_views(
    "SELECT event_id, user_id, NULLIF(event_type, 'unknown') AS event_type, value FROM events_dirty",
    "events_dirty"))
def q_value_to_null(spark, sf):
    return C.value_to_null(_ev(spark, sf), ["event_type"], "unknown")


@query("regex_filter_rows",
       "SELECT doc_id, lang, source FROM documents WHERE regexp_matches(text, '(?i)(?:licen[cs]e)|(?:secret)')")
def q_regex_filter_rows(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    return C.regex_filter_rows(df, "text", "(?:licen[cs]e)|(?:secret)").drop("text")


_FUNNEL = [
    ("has_type", "event_type IS NOT NULL"),
    ("known_type", "event_type <> 'unknown'"),
    ("has_value", "value IS NOT NULL"),
    ("non_negative", "value >= 0"),
    ("under_cap", "value <= 400"),
]


def _funnel_sql():
    parts = ["SELECT 0 AS step, 'input' AS name, count(*) AS n_rows FROM events_dirty"]
    cond = "TRUE"
    for i, (name, pred) in enumerate(_FUNNEL, start=1):
        cond = f"{cond} AND coalesce({pred}, FALSE)"
        parts.append(f"SELECT {i} AS step, '{name}' AS name, count_if({cond}) AS n_rows FROM events_dirty")
    return with_views(union_all(parts), "events_dirty")


@query("cleaning_funnel", _funnel_sql())
def q_cleaning_funnel(spark, sf):
    return C.cleaning_funnel(_ev(spark, sf), [(n, F.expr(p)) for n, p in _FUNNEL])


@query("select_columns", "SELECT p_partkey, p_name, p_retailprice FROM part")
def q_select_columns(spark, sf):
    return C.select_columns(table(spark, sf, "part"), ["p_partkey", "p_name", "missing_column", "p_retailprice"])


def _names_kind(spark, pairs):
    return spark.createDataFrame(list(pairs), "column_name string, kind string")


_DUCK_NUMERIC = "('TINYINT','SMALLINT','INTEGER','BIGINT','HUGEINT','FLOAT','DOUBLE') OR column_type LIKE 'DECIMAL%'"


def _kinds(df, kinds):
    """(column_name, kind, n_values): the columns of each kind with their non-null counts, in one scan."""
    names = [(c, k) for k, cols in kinds for c in cols]
    row = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("kind"), F.count(qcol(c)).alias("n_values")) for c, k in names])
    return df.agg(row.alias("r")).select(F.inline("r"))


@query("numeric_columns", "SELECT * FROM (" + union_all(
    [f"SELECT '{c}' AS column_name, '{k}' AS kind, count({c}) AS n_values FROM orders" for c, k in (
        ("o_orderkey", "numeric"), ("o_custkey", "numeric"), ("o_totalprice", "numeric"), ("o_orderstatus", "categorical"),
        ("o_orderpriority", "categorical"), ("o_orderdate", "datetime"))]) + ")")
def q_numeric_columns(spark, sf):
    from ..operators.profile import categorical_columns, datetime_columns, numeric_columns
    df = table(spark, sf, "orders")
    return _kinds(df, [("numeric", numeric_columns(df)), ("categorical", categorical_columns(df)), ("datetime", datetime_columns(df))])


@query("nested_type_columns", "SELECT 'embedding' AS column_name, 'nested' AS kind, count(embedding) AS n_values FROM embeddings")
def q_nested_type_columns(spark, sf):
    from ..operators.profile import nested_type_columns
    df = table(spark, sf, "embeddings")
    return _kinds(df, [("nested", nested_type_columns(df))])


@query("columns_by_regex", "SELECT l_orderkey, l_partkey FROM lineitem")
def q_columns_by_regex(spark, sf):
    df = table(spark, sf, "lineitem")
    return df.select(*C.columns_by_regex(df, "key", ["l_supp"]))


@query("drop_columns", "SELECT p_partkey, p_name, p_size, p_retailprice * 2 AS doubled FROM part")
def q_drop_columns(spark, sf):
    df = C.drop_columns(table(spark, sf, "part"), ["p_brand", "p_type"])
    df = C.set_column(df, "doubled", F.col("p_retailprice") * 2)
    assert C.contains_column(df, "doubled")
    return C.drop_columns(df, ["p_retailprice"]).select("p_partkey", "p_name", "p_size", "doubled")


@query("lowercase_columns", "SELECT * FROM nation")
def q_lowercase_columns(spark, sf):
    df = table(spark, sf, "nation")
    shouted = df.toDF(*[f"  {c.upper()} " for c in df.columns])
    return C.lowercase_columns(C.strip_columns(shouted))


@query("sanitize_column_name",
       "SELECT page_id, replace(regexp_replace(url, '[\\\\/*?:\"<>|]', '_', 'g'), ' ', '_') AS safe_name FROM pages")
def q_sanitize_column_name(spark, sf):
    from ..functions.scalar import sanitize_name_expr
    return table(spark, sf, "pages").select("page_id", sanitize_name_expr("url").alias("safe_name"))


@query("narrow_numeric_types")
def q_narrow_numeric_types(spark, sf):
    return C.narrow_numeric_types(table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice"))


