"""Supervised models used by the reference (inventory #150-151) on ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import qcol
from .relational import hash_split


def _assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="skip").transform(df)


def _scores(pred: DataFrame, label: str, col: str = "prediction") -> tuple[float, float]:
    row = pred.agg(F.avg((F.col(col) - qcol(label)) ** 2).alias("mse"), F.var_pop(qcol(label)).alias("v")).first()
    mse = float(row["mse"])
    r2 = 1.0 - mse / row["v"] if row["v"] else float("nan")
    return mse, r2


def regression_compare(df: DataFrame, features: Sequence[str], target: str, key: str, test_fraction: float = 0.2,
                       seed: int = 42, knn_k: int = 5, trees: int = 100) -> DataFrame:
    """(model, mse, r2) on a held-out md5 split for linear regression, random forest and
    k-nearest-neighbour regression. Large tables of few different feature vectors grow the same kind of forest from
    counts (``forest``), with other random numbers than Spark's."""
    from pyspark.ml.regression import LinearRegression, RandomForestRegressor

    from . import forest
    from .neighbours import knn_join

    data = df.dropna(subset=list(features) + [target]).select(*[qcol(c) for c in dict.fromkeys([key, *features, target])])
    train, test = (part.persist() for part in hash_split(data, key, test_fraction, seed))
    tr, te = _assemble(train, features), _assemble(test, features)
    rows = []
    lin = LinearRegression(featuresCol="features", labelCol=target, solver="normal").fit(tr)
    rows.append(("linear_regression",) + _scores(lin.transform(te), target))
    counted = forest.fit(tr, features, target, trees, seed)
    if counted:
        pred = counted.transform(te, target)
    else:
        pred = RandomForestRegressor(featuresCol="features", labelCol=target, numTrees=trees, seed=seed).fit(tr).transform(te)
    rows.append(("random_forest",) + _scores(pred, target))
    nn = knn_join(te, tr, list(features), knn_k, key, key, payload=target)
    knn_pred = nn.groupBy("qid").agg(F.avg("payload").alias("prediction")).join(
        te.select(qcol(key).cast("long").alias("qid"), qcol(target)), "qid")
    rows.append(("knn_regression",) + _scores(knn_pred, target))
    train.unpersist()
    test.unpersist()
    return df.sparkSession.createDataFrame(rows, "model string, mse double, r2 double")


def rf_classifier_importances(df: DataFrame, features: Sequence[str], label: str, key: str,
                              test_fraction: float = 0.2, seed: int = 42, trees: int = 100) -> DataFrame:
    """(feature, importance, accuracy) sorted by importance, from a random forest
    trained on an md5 split and scored on the held-out part."""
    from pyspark.ml.classification import RandomForestClassifier

    train, test = hash_split(df.dropna(subset=list(features) + [label]), key, test_fraction, seed)
    model = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, seed=seed).fit(
        _assemble(train.withColumn(label, qcol(label).cast("double")), features))
    pred = model.transform(_assemble(test.withColumn(label, qcol(label).cast("double")), features))
    acc = pred.agg(F.avg((F.col("prediction") == qcol(label)).cast("double"))).first()[0]
    imp = model.featureImportances.toArray()
    rows = sorted(((f, float(v), acc) for f, v in zip(features, imp)), key=lambda r: (-r[1], r[0]))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double, accuracy double")
