"""Registry of named queries over the driver tables, each paired (where SQL can state it)
with an equivalent DuckDB query used as the correctness oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.readers import scan_parquet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


# Dirty views of FIXTURES.md: nulls / sentinels / negatives injected by key, the same
# expressions on the Spark and DuckDB side.
EVENTS_DIRTY_COLS = [
    "event_id", "user_id", "ts",
    "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'unknown' ELSE event_type END AS event_type",
    "CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 17 = 0 THEN -value ELSE value END AS value",
]
PART_DIRTY_COLS = [
    "p_partkey", "p_type",
    "CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_brand END AS p_brand",
    "CASE WHEN p_partkey % 19 = 0 THEN '  ' ELSE p_name END AS p_name",
    "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_size END AS p_size",
    "p_retailprice",
]
EVENTS_DIRTY_SQL = "SELECT " + ", ".join(EVENTS_DIRTY_COLS) + " FROM events"
PART_DIRTY_SQL = "SELECT " + ", ".join(PART_DIRTY_COLS) + " FROM part"
DOC_LABELS_SQL = (
    "SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
)


def with_views(sql: str, *views: str) -> str:
    """Prefix an oracle query with the CTEs it needs."""
    defs = {"events_dirty": EVENTS_DIRTY_SQL, "part_dirty": PART_DIRTY_SQL, "doc_labels": DOC_LABELS_SQL}
    sep = " " if sql.lstrip().upper().startswith("SELECT") or sql.lstrip().startswith("(") else ", "
    return "WITH " + ", ".join(f"{v} AS ({defs[v]})" for v in views) + sep + sql


def events_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*EVENTS_DIRTY_COLS)


def part_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*PART_DIRTY_COLS)


def doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id")
