"""The mixtures of a selection are fitted side by side, each as it would be alone, on rows spread over enough tasks."""

import threading

import numpy as np
from pyspark.sql import functions as F

from framewright.operators import cluster as CL


def _frame(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.3, size=(60, 2)) for c in (0.0, 4.0, 9.0)])
    return spark.createDataFrame([(float(a), float(b)) for a, b in x], "a double, b double").coalesce(1)


def test_fits_run_side_by_side_with_the_scores_of_single_fits(spark, monkeypatch):
    df, alone, met = _frame(spark), {}, threading.Barrier(2)
    for k in (2, 3):
        alone[k] = CL.silhouette(CL.gmm(df, ["a", "b"], k, 42)[0], ["a", "b"], "cluster")
    one = CL.gmm

    def both(*args):
        met.wait(60)  # one after the other, nobody would come
        return one(*args)

    monkeypatch.setattr(CL, "gmm", both)
    got = {r.k: r.silhouette for r in CL.gmm_select_k(df, ["a", "b"], 3).collect()}
    assert got == alone


def test_many_rows_in_one_partition_are_spread(spark):
    df = spark.range(1000).coalesce(1).withColumn("v", F.col("id") * 2)
    assert CL.spread_rows(df, 1000).rdd.getNumPartitions() == 1
    wide = CL.spread_rows(df, 1000, most_rows=300)
    assert wide.rdd.getNumPartitions() == 4 and wide.agg(F.sum("v")).first()[0] == 999_000
