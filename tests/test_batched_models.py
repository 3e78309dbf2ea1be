"""Shared-scan k-means, chained imputation on sufficient statistics, Davies-Bouldin by blocks, forest samples."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.operators import cluster as CL
from framewright.operators import encode, impute, lloyd
from framewright.operators import evaluate as EV
from framewright.operators.iforest import isolation_forest_flag


def test_starts_reach_the_single_start_or_less(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    r = np.random.default_rng(1)
    x = np.concatenate([r.normal(m, 1, (n, 1)) for m, n in ((0, 40), (30, 40), (100, 30), (260, 10), (900, 3))] + [np.full((300, 1), 5.0)])
    df = spark.createDataFrame([([float(v) for v in row],) for row in x], "x array<double>")
    best = lloyd.kmeans_starts(df, "x", [1, 5], starts=10)
    single = KMeans(k=5, seed=42, featuresCol="f").fit(df.select(array_to_vector("x").alias("f"))).summary.trainingCost
    assert best[5][1] <= single * (1 + 1e-9) and len(best[5][0]) == 5
    assert best[1][1] == pytest.approx(((x - x.mean()) ** 2).sum())
    curve = {r.k: r.inertia for r in CL.elbow_curve(df, "x", 3).collect()}
    assert curve[1] == pytest.approx(best[1][1]) and curve[3] < curve[1]
    assert lloyd.kmeans_starts(df.limit(0), "x", [2])[2][0].size == 0


def test_category_clusters_follow_the_counts(spark):
    rows = [("a",)] * 50 + [("b",)] * 49 + [("c",)] * 5 + [("d",)] * 4 + [(None,)] * 3
    got = encode.cluster_categories(spark.createDataFrame(rows, "v string"), "v", n_clusters=2, out="g").distinct().collect()
    assert {r.v: r.g for r in got} == {"a": "Cluster_1", "b": "Cluster_1", "c": "Cluster_0", "d": "Cluster_0", None: None}
    few = encode.cluster_categories(spark.createDataFrame([("a",), ("b",)], "v string"), "v", n_clusters=5, out="g").collect()
    assert {r.g for r in few} == {"Cluster_0"}


def chained(x, rounds=400):
    gone = np.isnan(x)
    out = np.where(gone, np.nanmean(x, axis=0), x)
    for _ in range(rounds):
        for c in range(x.shape[1]):
            o = [i for i in range(x.shape[1]) if i != c]
            if gone[:, c].any():
                a = np.column_stack([np.ones(len(x)), out[:, o]])
                beta = np.linalg.lstsq(a[~gone[:, c]], out[~gone[:, c], c], rcond=None)[0]
                out[gone[:, c], c] = a[gone[:, c]] @ beta
    return out


def test_chained_imputation_reaches_the_fixed_point(spark, monkeypatch):
    r = np.random.default_rng(5)
    x = r.normal(size=(120, 3)) @ np.array([[1, 0.8, 0.2], [0, 1, 0.5], [0, 0, 1]]) * [1, 50, 1000] + [3, -7, 1e4]
    x[r.random(x.shape) < 0.2] = np.nan
    cells = [(i, *[None if np.isnan(v) else float(v) for v in row], None) for i, row in enumerate(x)]
    df = spark.createDataFrame(cells, "id long, a double, b double, c double, empty double")
    want = chained(x)
    got = impute.impute_iterative(df, ["a", "b", "c", "empty"], tol=1e-9).orderBy("id")
    assert got.columns == df.columns and got.where("empty is not null").count() == 0
    assert np.allclose(got.select("a", "b", "c").toPandas().to_numpy(), want, rtol=1e-5)
    monkeypatch.setattr(impute, "GRAM_LIMIT", 10)
    again = impute.impute_iterative(df.drop("empty"), ["a", "b", "c"], tol=0.05).orderBy("id")
    assert np.nanmax(np.abs(again.select("a", "b", "c").toPandas().to_numpy() - want) / np.std(want, axis=0)) < 0.3


def test_davies_bouldin_of_many_clusters(spark):
    r = np.random.default_rng(2)
    x, lab = r.normal(size=(900, 3)), np.repeat(np.arange(300), 3)
    df = spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, lab)], "x array<double>, label int")
    cent = x.reshape(300, 3, 3).mean(1)
    s = np.sqrt(((x - cent[lab]) ** 2).sum(1)).reshape(300, 3).mean(1)
    d = np.sqrt(((cent[:, None] - cent[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    want = ((s[:, None] + s[None]) / d).max(1).mean()
    assert EV.davies_bouldin(df, "x", "label", block_rows=64) == pytest.approx(want)
    assert EV.davies_bouldin(df.where("label = 1"), "x", "label") is None


def test_forest_of_one_column_equals_the_walk(spark):
    r = np.random.default_rng(4)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(r.normal(size=600))] + [(1000, 40.0), (1001, None)], "k long, v double")
    one = isolation_forest_flag(df, "v", "k", n_trees=20).orderBy("k").toPandas()
    two = isolation_forest_flag(df.withColumn("w", F.when(F.col("v").isNotNull(), 1.0)), ["v", "w"], "k", n_trees=20).orderBy("k").toPandas()
    assert one.outlier_iforest_v.tolist()[-2:] == [1, 0] and 20 <= one.outlier_iforest_v.sum() <= 31
    assert (one.outlier_iforest_v != two.outlier_iforest_v_w).mean() < 0.1
