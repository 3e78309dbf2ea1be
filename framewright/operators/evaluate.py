"""Cluster and classifier evaluation (inventory 2.14).

Centroid-based metrics (Davies-Bouldin, Calinski-Harabasz, inertia) are linear in n:
one grouped vector aggregate gives the k centroids (a table of k rows, broadcast), one
pass measures distances. The exact euclidean silhouette needs every pairwise distance:
rows are split into a bounded number of blocks, whose pairwise sums are computed in
vectorised numpy and reduced per point and cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import checked_broadcast, qcol
from .relational import top_k_per_group


# --------------------------------------------------------------------------- features
def feature_array(df: DataFrame, features: str | Sequence[str]) -> Column:
    """array<double> from either one array / vector column or a list of numeric columns."""
    if isinstance(features, str):
        dt = df.schema[features].dataType
        if isinstance(dt, T.ArrayType):
            return qcol(features).cast("array<double>")
        from pyspark.ml.functions import vector_to_array
        return vector_to_array(qcol(features))
    return F.array(*[qcol(c).cast("double") for c in features])


def sq_dist(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)


def centroids(df: DataFrame, features, label: str) -> DataFrame:
    """(label, n, centroid array) per cluster via the vector Summarizer (partial aggregates)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    v = df.select(qcol(label).alias("__l"), array_to_vector(feature_array(df, features)).alias("__v"))
    s = v.groupBy("__l").agg(Summarizer.metrics("mean", "count").summary(F.col("__v")).alias("__s"))
    return s.select(F.col("__l"), F.col("__s.count").alias("__n"), vector_to_array(F.col("__s.mean")).alias("__c"))


def _with_centroid(df: DataFrame, features, label: str) -> tuple[DataFrame, DataFrame]:
    """(rows joined to their centroid, the cached centroid table to release after use)."""
    # one row per cluster: broadcast after a size check (a near-unique label would not be)
    cent = checked_broadcast(centroids(df, features, label))
    joined = df.select(qcol(label).alias("__l"), feature_array(df, features).alias("__x")).join(cent, "__l")
    return joined, cent


# --------------------------------------------------------------------------- centroid metrics
def inertia(df: DataFrame, features, label: str) -> float:
    """Sum of squared distances of points to their cluster centroid."""
    j, cent = _with_centroid(df, features, label)
    value = float(j.agg(F.sum(sq_dist(F.col("__x"), F.col("__c")))).first()[0] or 0.0)
    cent.unpersist()
    return value


def _worst_ratios(pdf: pd.DataFrame) -> pd.DataFrame:
    """Left block x right block of centroids: per left cluster the largest (s_i + s_j) / d(c_i, c_j)."""
    left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
    if left.empty or right.empty:
        return pd.DataFrame({"id": pd.Series(dtype="int64"), "r": pd.Series(dtype="float64")})
    cl, cr = np.stack(left["c"].to_numpy()), np.stack(right["c"].to_numpy())
    s, out = right["s"].to_numpy(), np.empty(len(cl))
    for i, (c, own, own_id) in enumerate(zip(cl, left["s"].to_numpy(), left["id"].to_numpy(), strict=True)):
        d = np.sqrt(((cr - c) ** 2).sum(1))
        d[(d == 0) | (right["id"].to_numpy() == own_id)] = np.inf
        out[i] = ((own + s) / d).max()
    return pd.DataFrame({"id": left["id"].to_numpy(), "r": out})


def davies_bouldin(df: DataFrame, features, label: str, block_rows: int = 1_000) -> float | None:
    """mean over clusters of max_{j != i} (s_i + s_j) / d(c_i, c_j), s = mean distance to centroid.

    Blocks of centroids are compared on the executors, and only maxima per cluster leave a block; the number
    of clusters has no limit."""
    j, cent = _with_centroid(df, features, label)
    per = j.groupBy("__l").agg(F.avg(F.sqrt(sq_dist(F.col("__x"), F.col("__c")))).alias("s"),
                               F.first("__c").alias("c")).withColumn("id", F.xxhash64("__l")).persist()
    k, spread = per.agg(F.count(F.lit(1)), F.max("s")).first()
    value = None
    if k >= 2:
        blocks = -(-k // block_rows)
        own, other = F.pmod("id", F.lit(blocks)), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        left = per.select("id", "s", "c", own.alias("a"), other.alias("p"), F.lit(0).alias("side"))
        right = per.select("id", "s", "c", other.alias("a"), own.alias("p"), F.lit(1).alias("side"))
        cols = ["id", "s", "c", F.col("a").cast("long").alias("a"), F.col("p").cast("long").alias("p"), "side"]
        worst = (left.select(*cols).unionByName(right.select(*cols)).groupBy("a", "p").applyInPandas(_worst_ratios, "id long, r double")
                 .groupBy("id").agg(F.max("r").alias("r")))
        value = 0.0 if spread <= 1e-8 else float(worst.agg(F.avg("r")).first()[0])
    per.unpersist()
    cent.unpersist()
    return value


def calinski_harabasz(df: DataFrame, features, label: str) -> float | None:
    """[B / (k - 1)] / [W / (n - k)] from per-cluster centroids and the global centroid;
    B is aggregated over the centroid table on Spark (nothing per cluster reaches the driver)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    cent = centroids(df, features, label).persist()
    sizes = cent.agg(F.count(F.lit(1)).alias("k"), F.sum("__n").alias("n")).first()
    k, n = sizes["k"], sizes["n"]
    if k < 2 or n is None or n <= k:
        cent.unpersist()
        return None
    g = df.select(array_to_vector(feature_array(df, features)).alias("v")).agg(
        vector_to_array(Summarizer.mean(F.col("v"))).alias("g")).first()["g"]  # d numbers
    g_lit = F.array(*[F.lit(float(v)) for v in g])
    b = float(cent.agg(F.sum(F.col("__n") * sq_dist(F.col("__c"), g_lit))).first()[0])
    cent.unpersist()
    w = inertia(df, features, label)
    return (b / (k - 1)) / (w / (n - k)) if w > 0 else float("inf")


def cluster_size_std(df: DataFrame, label: str, k: int | None = None, noise: int | None = None) -> float | None:
    """Population std of cluster sizes. With ``k``, ids 0..k-1 are counted (empty ones as 0);
    ``noise`` excludes that label (density clustering)."""
    d = df.where(qcol(label) != noise) if noise is not None else df
    sizes = d.groupBy(qcol(label).alias("l")).agg(F.count(F.lit(1)).alias("n"))
    if k is not None:
        grid = df.sparkSession.range(k).select(F.col("id").cast(df.schema[label].dataType).alias("l"))
        sizes = grid.join(sizes, "l", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    return sizes.agg(F.stddev_pop("n")).first()[0]


def noise_stats(df: DataFrame, label: str, noise: int = -1) -> DataFrame:
    """(n_clusters, n_noise, noise_ratio) for density clustering labels."""
    return df.agg(F.count_distinct(F.when(qcol(label) != noise, qcol(label))).alias("n_clusters"),
                  F.count_if(qcol(label) == noise).alias("n_noise"),
                  (F.count_if(qcol(label) == noise) / F.count(F.lit(1))).alias("noise_ratio"))


# --------------------------------------------------------------------------- exact silhouette
def _block_sums(pdf: pd.DataFrame) -> pd.DataFrame:
    """Left block x right block: for every left point, sum of euclidean distances and
    count per right-side cluster. Emits one row per (point, cluster), not per pair."""
    left = pdf[pdf["side"] == 0]
    right = pdf[pdf["side"] == 1]
    if left.empty or right.empty:
        return pd.DataFrame({"id": pd.Series(dtype="int64"), "cl": pd.Series(dtype="int64"),
                             "dsum": pd.Series(dtype="float64"), "cnt": pd.Series(dtype="int64")})
    xl = np.stack(left["x"].to_numpy()).astype(float)
    xr = np.stack(right["x"].to_numpy()).astype(float)
    l2, cl = (xl * xl).sum(1)[:, None], right["cl"].to_numpy()
    out = []
    for c in np.unique(cl):
        sel = xr[cl == c]
        sums = np.zeros(len(xl))
        for s in range(0, len(sel), 1024):  # tiles of both sides, so memory does not grow with a block
            chunk = sel[s:s + 1024]
            r2 = (chunk * chunk).sum(1)[None, :]
            for t in range(0, len(xl), 512):
                d2 = l2[t:t + 512] + r2 - 2 * xl[t:t + 512] @ chunk.T
                sums[t:t + 512] += np.sqrt(np.maximum(d2, 0.0, out=d2), out=d2).sum(1)
        out.append(pd.DataFrame({"id": left["id"].to_numpy(), "cl": int(c), "dsum": sums, "cnt": len(sel)}))
    return pd.concat(out, ignore_index=True)


def silhouette_blocks(n: int, block_rows: int = 1_000, most_blocks: int = 16, most_rows: int = 65_536) -> int:
    """Blocks for the n^2 distances of n rows. A row is shuffled once per block and side, so their number stays at
    ``most_blocks`` while a block holds at most ``most_rows`` rows; only beyond that, to bound a task's memory, it grows."""
    return max(1, min(-(-n // block_rows), most_blocks), -(-n // most_rows))


def silhouette_exact(df: DataFrame, features, label: str, key: str, block_rows: int = 1_000) -> float | None:
    """Mean euclidean silhouette of every row given: all n^2 distances, in pairs of blocks (``silhouette_blocks``).
    Time is quadratic in the rows; ``silhouette`` is the linear measure. Vectors travel in their own element type."""
    whole = df.schema[features].dataType if isinstance(features, str) else None
    x = qcol(features) if isinstance(whole, T.ArrayType) and isinstance(whole.elementType, T.FloatType) else feature_array(df, features)
    pts = df.select(qcol(key).alias("__key"), qcol(label).cast("long").alias("cl"), x.alias("x"))
    integral = isinstance(df.schema[key].dataType, T.IntegralType)
    pts = pts.withColumn("id", F.col("__key").cast("long") if integral else F.xxhash64("__key")).persist()
    n = pts.count()
    if n < 2:
        pts.unpersist()
        return None
    blocks = silhouette_blocks(n, block_rows)
    b = pts.withColumn("blk", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    left = (b.select("id", "cl", "x", "blk", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("partner"))
            .select("id", "cl", "x", F.col("blk").alias("a"), F.col("partner").alias("p"), F.lit(0).alias("side")))
    right = (b.select("id", "cl", "x", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("a"),
                      F.col("blk").alias("p"))
             .select("id", "cl", "x", "a", "p", F.lit(1).alias("side")))
    # as many partitions as there are pairs of blocks, up to what Spark shuffles into anyway
    parts = min(blocks * blocks, max(df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    sums = (left.unionByName(right).repartition(parts, "a", "p").groupBy("a", "p")
            .applyInPandas(_block_sums, "id long, cl long, dsum double, cnt long")
            .groupBy("id", "cl").agg(F.sum("dsum").alias("dsum"), F.sum("cnt").alias("cnt")))
    own = pts.select("id", F.col("cl").alias("own"))
    j = sums.join(own, "id")
    per_point = j.groupBy("id").agg(
        F.max(F.when(F.col("cl") == F.col("own"), F.col("cnt"))).alias("n_own"),
        F.max(F.when(F.col("cl") == F.col("own"), F.col("dsum"))).alias("d_own"),
        F.min(F.when(F.col("cl") != F.col("own"), F.col("dsum") / F.col("cnt"))).alias("b"))
    a = F.col("d_own") / (F.col("n_own") - 1)
    s = F.when((F.col("n_own") > 1) & F.col("b").isNotNull(),
               (F.col("b") - a) / F.greatest(a, F.col("b"))).otherwise(F.lit(0.0))
    val = per_point.agg(F.avg(s)).first()[0]
    n_clusters = pts.agg(F.count_distinct("cl")).first()[0]
    pts.unpersist()
    if n_clusters < 2 or n_clusters >= n:
        return None
    return float(val)


def silhouette(df: DataFrame, features, label: str) -> float | None:
    """Mean silhouette of every row on squared euclidean distance (Spark's ClusteringEvaluator,
    O(n k)): a different number from the euclidean one. Null for fewer than two clusters."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    v = df.select(array_to_vector(feature_array(df, features)).alias("features"),
                  qcol(label).cast("double").alias("prediction"))
    v = v.where(F.col("prediction").isNotNull())
    if v.select("prediction").distinct().limit(2).count() < 2:
        return None
    return float(ClusteringEvaluator(featuresCol="features", predictionCol="prediction").evaluate(v))


def evaluate_clusters(df: DataFrame, features, label: str, kind: str = "kmeans", key: str | None = None,
                      k: int | None = None) -> DataFrame:
    """Long (metric, value) table over all rows. ``kind`` is 'kmeans' or 'dbscan' (others are refused);
    with 'dbscan' the noise label -1 is a group of its own in the silhouette, which is null for fewer than two clusters."""
    if kind not in ("kmeans", "dbscan"):
        raise ValueError("evaluate_clusters supports kind='kmeans' or 'dbscan'")
    spark = df.sparkSession
    # every metric reads (key, label, features): project and cache them once
    keep = [qcol(label)] + ([qcol(key)] if key is not None and key != label else [])
    df = df.select(*keep, feature_array(df, features).alias("__fx")).persist()
    features = "__fx"
    rows = []
    if kind == "dbscan":
        ns = noise_stats(df, label).first()
        rows += [("n_clusters", float(ns["n_clusters"])), ("noise_ratio", float(ns["noise_ratio"]))]
        rows.append(("silhouette", silhouette(df, features, label) if ns["n_clusters"] > 1 else None))
        rows.append(("cluster_size_std", cluster_size_std(df, label, noise=-1)))
    else:
        rows += [("silhouette", silhouette(df, features, label)), ("davies_bouldin", davies_bouldin(df, features, label)),
                 ("calinski_harabasz", calinski_harabasz(df, features, label)),
                 ("inertia", inertia(df, features, label)),
                 ("cluster_size_std", cluster_size_std(df, label, k=k))]
    df.unpersist()
    return spark.createDataFrame([(m, None if v is None else float(v)) for m, v in rows], "metric string, value double")


# --------------------------------------------------------------------------- classification
def misclassified_rows(df: DataFrame, y_true: str, y_pred: str) -> DataFrame:
    """Rows whose prediction differs from the truth, with the error rate of the whole input. A null
    on one side only is a difference."""
    wrong = ~qcol(y_true).eqNullSafe(qcol(y_pred))
    rate = df.agg(F.avg(wrong.cast("double"))).first()[0]
    return df.where(wrong).withColumn("error_rate", F.lit(rate).cast("double"))


def confusion_matrix(df: DataFrame, y_true: str, y_pred: str, labels: Sequence | None = None,
                     max_labels: int = 1_000) -> DataFrame:
    """Rows = true label, one count column per label (labels present in y_true, sorted).
    The label set is small by nature (classes), so it is collected to fix the schema."""
    if labels is None:
        distinct = df.select(qcol(y_true)).where(qcol(y_true).isNotNull()).distinct()
        if distinct.limit(max_labels + 1).count() > max_labels:
            raise ValueError(f"more than {max_labels} classes: a confusion matrix is not meaningful")
        labels = sorted(r[0] for r in distinct.collect())
    labels = list(labels)
    counts = (df.where(qcol(y_true).isin(labels))
              .groupBy(qcol(y_true).alias("y_true")).pivot(y_pred, labels).count())
    grid = df.sparkSession.createDataFrame([(v,) for v in labels], T.StructType(
        [T.StructField("y_true", df.schema[y_true].dataType)]))
    out = grid.join(counts, "y_true", "left")
    return out.select("y_true", *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).cast("bigint").alias(str(v)) for v in labels])


def classification_report(df: DataFrame, y_true: str, y_pred: str) -> DataFrame:
    """(label, precision, recall, f1, support) per label plus accuracy, macro avg and
    weighted avg rows; 0 where a denominator is 0. All from one grouped count."""
    pairs = df.groupBy(qcol(y_true).alias("t"), qcol(y_pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    tp = pairs.where(F.col("t") == F.col("p")).select(F.col("t").alias("label"), F.col("n").alias("tp"))
    sup = pairs.groupBy(F.col("t").alias("label")).agg(F.sum("n").alias("support"))
    pred = pairs.groupBy(F.col("p").alias("label")).agg(F.sum("n").alias("predicted"))
    per = (sup.join(pred, "label", "left").join(tp, "label", "left")
           .select(F.col("label").cast("string").alias("label"),
                   F.coalesce(F.col("tp") / F.col("predicted"), F.lit(0.0)).alias("precision"),
                   F.coalesce(F.col("tp") / F.col("support"), F.lit(0.0)).alias("recall"),
                   F.col("support").cast("bigint").alias("support")))
    per = per.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                       F.col("precision") + F.col("recall")), F.lit(0.0)))
    per = per.select("label", "precision", "recall", "f1", "support")
    totals = per.agg(F.sum("support").alias("n"), F.avg("precision").alias("mp"), F.avg("recall").alias("mr"),
                     F.avg("f1").alias("mf"), (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
                     (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
                     (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"))
    acc = df.agg(F.avg((qcol(y_true) == qcol(y_pred)).cast("double"))).first()[0]
    def row(name, p, r, f):
        return F.struct(F.lit(name).alias("label"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1"),
                        F.col("n").cast("bigint").alias("support"))

    none = F.lit(None)
    summary = totals.select(F.inline(F.array(
        row("accuracy", none, none, F.lit(acc)), row("macro avg", F.col("mp"), F.col("mr"), F.col("mf")),
        row("weighted avg", F.col("wp"), F.col("wr"), F.col("wf")))))
    return per.unionByName(summary)


def cluster_token_counts(df: DataFrame, text: str, cluster: str, top: int = 100, min_len: int = 2) -> DataFrame:
    """Most frequent lower-cased word tokens per cluster (whole texts, no concatenation):
    (cluster, token, count, rank)."""
    toks = (df.select(qcol(cluster).alias("cluster"),
                      F.explode(F.split(F.lower(qcol(text)), r"[^\p{L}\p{N}_]+")).alias("token"))
            .where(F.length("token") >= min_len))
    counts = toks.groupBy("cluster", "token").agg(F.count(F.lit(1)).alias("count"))
    return top_k_per_group(counts, "cluster", "count", top, tie=["token"])
