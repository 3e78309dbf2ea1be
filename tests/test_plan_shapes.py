"""Plan-shape guards on a representative subset (tools/plan_audit.py covers every query)."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
BAD = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("key", ["events_clean_summary", "target_encode", "impute_group_mean", "top_k_per_group",
                                 "sample_stratified", "frequency_encode", "classification_report",
                                 "dimension_count_join", "table_summary", "value_counts"])
def test_no_cartesian_or_nested_loop(spark, key):
    plan = entry.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [b for b in BAD if b in plan]


def test_group_limit_before_exchange(spark):
    plan = entry.queries()["top_k_per_group"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_float_range_filter_pushed_to_parquet(spark):
    plan = entry.queries()["scan_parquet"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_quantity,45" in plan


def test_rows_of_the_neighbour_join_are_never_broadcast(spark, tmp_path):
    from framewright.operators.neighbours import eps_neighbour_join
    # 120,000 rows in a file of few bytes: by Spark's estimate the rows are a smaller table than their cells' sizes
    spark.range(120_000).selectExpr("id", "double(id div 3000) as x", "0D as y").repartition(2).write.parquet(str(tmp_path / "rows"))
    out = eps_neighbour_join(spark.read.parquet(str(tmp_path / "rows")), ["x", "y"], 0.5, "id")
    joins = [line.split("BroadcastHashJoin")[-1].split("],")[0] for line in out._jdf.queryExecution().executedPlan().toString().splitlines()
             if "HashJoin" in line or "SortMergeJoin" in line]
    assert sum("SortMergeJoin" in j for j in joins) == 2
