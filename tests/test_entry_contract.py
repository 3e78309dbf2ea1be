"""Driver contract: entry() runs on sf0.001, every oracle key is a registered query,
and a fast subset of queries agrees with DuckDB at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert set(df.columns) == {"event_type", "n", "mean_value", "std_value", "min_value", "max_value"}
    assert len(rows) >= 0


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, bool):
        return int(v)
    return v


@pytest.mark.parametrize("key", ["events_clean_summary", "cleaning_funnel", "iqr_remove", "describe_column",
                                 "target_encode", "leave_one_out_encode", "scale_auto", "impute_linear_regression",
                                 "classification_report", "top_k_per_group", "sample_stratified"])
def test_query_matches_duckdb_small(spark, key):
    sf = "/root/testdata/sf0.001"
    sdf = entry.queries()[key](spark, sf)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    res = con.execute(entry.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    order_s = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
    order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
    a = sorted((tuple(_norm(r[i]) for i in order_s) for r in sdf.collect()), key=repr)
    b = sorted((tuple(_norm(r[i]) for i in order_d) for r in res.fetchall()), key=repr)
    assert a == b
