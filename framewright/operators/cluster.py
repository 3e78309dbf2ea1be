"""Clustering (inventory #143-149): k-means, bisecting k-means, Gaussian mixtures via
``pyspark.ml`` (distributed Lloyd / EM iterations). DBSCAN is in ``density``, components are in ``graph``."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .density import dbscan, dbscan_grid_search, relabel_noise  # noqa: F401
from .evaluate import feature_array, silhouette
from .graph import connected_components  # noqa: F401


def _vectors(df: DataFrame, features, out: str = "features") -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out, array_to_vector(feature_array(df, features)))


def assemble_standardized(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Standardise (population std, nulls as 0) then assemble one dense vector column."""
    from .scale import scale_standard
    return _vectors(scale_standard(df, cols), list(cols), out)


# --------------------------------------------------------------------------- k-means family
def absolute_tolerance(v: DataFrame, k: int, tol: float = 1e-4, col: str = "__features") -> float:
    """Spark stops when every centre moves by at most eps; the reference's rule is a total
    squared shift <= tol * mean feature variance. eps = sqrt(tol * mean_var / k) makes the
    first imply the second."""
    from pyspark.ml.stat import Summarizer

    var = v.agg(Summarizer.variance(F.col(col)).alias("v")).first()["v"]
    mean_var = float(np.mean(var.toArray())) if var is not None else 0.0
    return float(np.sqrt(tol * mean_var / k)) if mean_var > 0 else 1e-12


def kmeans(df: DataFrame, features, k: int = 5, seed: int = 42, out: str = "cluster", max_iter: int = 300,
           tol: float = 1e-4):
    """Fit ml KMeans (k-means||, seed) and add ``out``. ``tol`` is relative to the mean
    feature variance, as in the reference. Returns (labelled frame, model)."""
    from pyspark.ml.clustering import KMeans

    v = _vectors(df, features, "__features").persist()
    eps = absolute_tolerance(v, k, tol)
    # features are dense arrays: the blocked (GEMM) solver computes the same centres faster
    model = KMeans(k=k, seed=seed, maxIter=max_iter, tol=eps, featuresCol="__features", predictionCol=out,
                   solver="block").fit(v)
    # label once, checkpoint the labels, then release the cached vectors
    labelled = materialize(model.transform(v).drop("__features"), [v])
    return labelled, model


def total_sum_of_squares(df: DataFrame, features) -> float:
    """Inertia of one cluster (k = 1): sum of squared distances to the global mean."""
    from .evaluate import centroids, sq_dist
    lab = df.withColumn("__one", F.lit(0))
    cent = centroids(lab, features, "__one")
    j = lab.select(F.lit(0).alias("__l"), feature_array(lab, features).alias("__x")).join(F.broadcast(cent), "__l")
    return float(j.agg(F.sum(sq_dist(F.col("__x"), F.col("__c")))).first()[0] or 0.0)


def elbow_curve(df: DataFrame, features, max_clusters: int = 10, seed: int = 42, max_iter: int = 300,
                tol: float = 1e-4, starts: int = 1) -> DataFrame:
    """(k, inertia) for k = 1..max_clusters, with the tolerance of ``kmeans``; every scan serves all k."""
    from .lloyd import kmeans_starts

    best = kmeans_starts(df, features, range(1, max_clusters + 1), starts, seed, max_iter, tol)
    return df.sparkSession.createDataFrame([(k, cost) for k, (_, cost) in sorted(best.items())], "k int, inertia double")


def bisecting_kmeans(df: DataFrame, features, k: int = 5, seed: int = 42, out: str = "cluster"):
    """Divisive hierarchy (stands in for single-machine agglomerative clustering)."""
    from pyspark.ml.clustering import BisectingKMeans

    v = _vectors(df, features, "__features")
    model = BisectingKMeans(k=k, seed=seed, featuresCol="__features", predictionCol=out).fit(v)
    return model.transform(v).drop("__features"), model


def gmm(df: DataFrame, features, k: int = 5, seed: int = 42, out: str = "cluster"):
    from pyspark.ml.clustering import GaussianMixture

    v = _vectors(df, features, "__features")
    model = GaussianMixture(k=k, seed=seed, featuresCol="__features", predictionCol=out,
                            probabilityCol="__prob").fit(v)
    return model.transform(v).drop("__features", "__prob"), model


def spread_rows(df: DataFrame, n: int, most_rows: int = 262_144) -> DataFrame:
    """``df`` in partitions of about ``most_rows`` rows where it has fewer: a small file is one task, however many
    rows it holds. Inputs that fit the partitions they have stay as they are."""
    parts = -(-n // most_rows)
    return df if df.rdd.getNumPartitions() >= parts else df.repartition(parts)


def gmm_select_k(df: DataFrame, features, max_clusters: int = 10, seed: int = 42, parallelism: int = 4) -> DataFrame:
    """(k, silhouette) for k = 2..max_clusters (squared-euclidean silhouette, O(n k); null where only one cluster has rows).

    The fits do not depend on each other, so ``parallelism`` of them run at a time, the largest first."""
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target

    spark, kept = df.sparkSession, df.persist()
    rows = spread_rows(kept, kept.count()).persist()

    def score(k: int):
        lab, _ = gmm(rows, features, k, seed)
        return k, silhouette(lab, features, "cluster")

    pool = ThreadPool(max(1, min(parallelism, max_clusters - 1)))
    try:
        found = pool.map(inheritable_thread_target(spark)(score), range(max_clusters, 1, -1), chunksize=1)
    finally:
        pool.close()
    rows.unpersist()
    kept.unpersist()
    return spark.createDataFrame(sorted(found), "k int, silhouette double")


def fit_predict_score(df: DataFrame, features, kind: str = "kmeans", k: int = 5, seed: int = 42):
    """Fit, label, and score with the silhouette when 1 < #labels < n. Returns (frame, score)."""
    fitters = {"kmeans": kmeans, "bisecting": bisecting_kmeans, "gmm": gmm}
    if kind not in fitters:
        raise ValueError(f"unknown model kind {kind!r}; choose from {sorted(fitters)}")
    lab, _ = fitters[kind](df, features, k, seed)
    stats = lab.agg(F.count_distinct("cluster").alias("c"), F.count(F.lit(1)).alias("n")).first()
    score = silhouette(lab, features, "cluster") if 1 < stats["c"] < stats["n"] else None
    return lab, score


def kmeans_clustering(df: DataFrame, cols: Sequence[str], k: int = 5, seed: int = 42,
                      corr_threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """The reference's clustering query: drop rows with nulls, drop highly correlated
    columns, keep rows inside the IQR fences of every column, standardise, k-means.
    Returns (labelled rows, cluster sizes)."""
    from .clean import iqr_row_mask
    from .scale import scale_standard
    from .select import drop_high_correlation

    base = df.dropna(subset=list(cols))
    kept = [c for c in drop_high_correlation(base.select(*cols), corr_threshold).columns]
    masked = iqr_row_mask(base, kept)
    scaled = scale_standard(masked, kept)
    lab, _ = kmeans(scaled, kept, k, seed)
    sizes = lab.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    return lab, sizes
