from pyspark.sql import functions as F

from framewright.operators import relational as R


def test_sample_n_threshold_path_equals_take_ordered(spark):
    df = spark.range(0, 20000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v")).repartition(16)
    small = {r.k for r in R.sample_n(df, 300, "k").collect()}
    big = {r.k for r in R.sample_n(df, 300, "k", merge_limit=0).collect()}
    assert len(small) == 300 and small == big


def test_stratified_sample_sizes(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("s"))
    out = R.sample_stratified(df, "s", 0.1, "k", accuracy=50)
    sizes = {r.s: r["count"] for r in out.groupBy("s").count().collect()}
    expected = {s: round(n * 0.1) for s, n in {0: 1667, 1: 1667, 2: 1666}.items()}
    assert sizes == expected
