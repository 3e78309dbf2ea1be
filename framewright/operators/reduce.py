"""Dimensionality reduction (inventory #136-142, #149).

The covariance is aggregated by Spark (``ml.feature.PCA`` / ``RowMatrix``: one
tree-aggregate over the rows); only the d x d eigenproblem runs on the driver.
Projections are written back as plain Column arithmetic over the standardised
inputs, so transform stays in whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import as_double, qcol
from .scale import fit_moments


def standardize_exprs(df: DataFrame, cols: Sequence[str]) -> tuple[list, dict]:
    """(x - mean) / population std with nulls as 0 — the scaler the reference applies first."""
    m = fit_moments(df, cols, True)
    exprs = [((F.coalesce(as_double(c), F.lit(0.0)) - F.lit(m[c]["mean"])) / F.lit(m[c]["std_pop"] or 1.0)).alias(c)
             for c in cols]
    return exprs, m


def fit_pca(df: DataFrame, cols: Sequence[str], k: int | None = None) -> dict:
    """Principal axes of the standardised columns. Components are sign-fixed so the
    largest absolute loading is positive. Eigenvalues use the n-1 covariance."""
    from pyspark.ml.feature import PCA, VectorAssembler

    cols = list(cols)
    exprs, moments = standardize_exprs(df, cols)
    std = df.select(*exprs)
    vec = VectorAssembler(inputCols=cols, outputCol="__v").transform(std).select("__v")
    d = len(cols)
    model = PCA(k=d, inputCol="__v", outputCol="__p").fit(vec)
    pc = np.array(model.pc.toArray().T, copy=True)  # (d components, d features)
    ratios = np.array(model.explainedVariance.toArray())
    n = std.count()
    total = float(sum(std.agg(*[F.var_samp(c).alias(c) for c in cols]).first()))
    eig = ratios * total
    for i in range(d):
        j = int(np.argmax(np.abs(pc[i])))
        if pc[i, j] < 0:
            pc[i] = -pc[i]
    k = k or d
    return {"cols": cols, "moments": moments, "components": pc[:k], "all_components": pc, "ratios": ratios,
            "eigenvalues": eig, "n": n, "k": k}


def project(df: DataFrame, fit: dict, whiten: bool = False, prefix: str = "pc", keep: Sequence[str] = ()) -> DataFrame:
    """Add pc_1..pc_k (optionally whitened) computed from the fitted axes."""
    exprs, _ = _std_exprs_from(fit)
    outs = []
    for i, comp in enumerate(fit["components"]):
        e = sum((F.lit(float(w)) * x for w, x in zip(comp, exprs)), F.lit(0.0))
        if whiten:
            e = e / F.lit(float(np.sqrt(fit["eigenvalues"][i])) or 1.0)
        outs.append(e.alias(f"{prefix}_{i + 1}"))
    return df.select(*[qcol(c) for c in keep], *outs)


def _std_exprs_from(fit: dict):
    m = fit["moments"]
    return [(F.coalesce(as_double(c), F.lit(0.0)) - F.lit(m[c]["mean"])) / F.lit(m[c]["std_pop"] or 1.0)
            for c in fit["cols"]], m


def pca(df: DataFrame, cols: Sequence[str], k: int, whiten: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    return project(df, fit_pca(df, cols, k), whiten=whiten, keep=keep)


def explained_variance_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(component, explained_variance, explained_variance_ratio, cumulative_ratio)."""
    f = fit_pca(df, cols)
    cum = np.cumsum(f["ratios"])
    rows = [(i + 1, float(f["eigenvalues"][i]), float(f["ratios"][i]), float(cum[i])) for i in range(len(f["ratios"]))]
    return df.sparkSession.createDataFrame(
        rows, "component int, explained_variance double, explained_variance_ratio double, cumulative_ratio double")


def choose_components(df: DataFrame, cols: Sequence[str], threshold: float = 0.95) -> int:
    """Smallest k whose cumulative explained variance ratio reaches the threshold."""
    f = fit_pca(df, cols)
    cum = np.cumsum(f["ratios"])
    return int(np.searchsorted(cum, threshold - 1e-12) + 1)


def top_loadings(df: DataFrame, cols: Sequence[str], top_n: int = 3, k: int | None = None) -> DataFrame:
    """(component, feature, loading, rank): features with the largest |loading| per component."""
    f = fit_pca(df, cols, k)
    rows = []
    for i, comp in enumerate(f["components"]):
        order = sorted(range(len(comp)), key=lambda j: (-abs(comp[j]), f["cols"][j]))[:top_n]
        rows += [(i + 1, f["cols"][j], float(comp[j]), r + 1) for r, j in enumerate(order)]
    return df.sparkSession.createDataFrame(rows, "component int, feature string, loading double, rank int")


def truncated_svd(df: DataFrame, cols: Sequence[str], k: int = 2, prefix: str = "svd",
                  keep: Sequence[str] = ()) -> DataFrame:
    """Uncentred SVD of the standardised matrix; returns X V with signs fixed like the
    PCA axes. The right singular vectors are the eigenvectors of the Gramian X^T X,
    which is assembled on the JVM from two vector aggregates (Summarizer moments and
    ``Correlation``): G = (n - 1) Cov + n mu mu^T. Only the d x d eigenproblem is local."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation, Summarizer

    _, moments = standardize_exprs(df, cols)
    std, _ = _std_exprs_from({"cols": list(cols), "moments": moments})
    vec = VectorAssembler(inputCols=list(cols), outputCol="__v").transform(
        df.select(*[e.alias(c) for e, c in zip(std, cols)])).select("__v").persist()
    s = vec.agg(Summarizer.metrics("mean", "variance", "count").summary(F.col("__v")).alias("s")).first()["s"]
    n, mu, var = float(s["count"]), s["mean"].toArray(), s["variance"].toArray()
    corr = np.nan_to_num(Correlation.corr(vec, "__v").first()[0].toArray())
    sd = np.sqrt(np.maximum(var, 0.0))
    gram = (n - 1.0) * corr * np.outer(sd, sd) + n * np.outer(mu, mu)
    vec.unpersist()
    eigval, eigvec = np.linalg.eigh(gram)
    order = np.argsort(eigval)[::-1][:k]
    v = np.array(eigvec[:, order].T, copy=True)
    for i in range(len(v)):
        j = int(np.argmax(np.abs(v[i])))
        if v[i, j] < 0:
            v[i] = -v[i]
    outs = [sum((F.lit(float(w)) * x for w, x in zip(comp, std)), F.lit(0.0)).alias(f"{prefix}_{i + 1}")
            for i, comp in enumerate(v)]
    return df.select(*[qcol(c) for c in keep], *outs)


def reconstruct(df: DataFrame, cols: Sequence[str], k: int, keep: Sequence[str] = ()) -> DataFrame:
    """Project on k axes and back, in the standardised space: x_hat = Z W."""
    f = fit_pca(df, cols, k)
    exprs, _ = _std_exprs_from(f)
    z = [sum((F.lit(float(w)) * x for w, x in zip(comp, exprs)), F.lit(0.0)) for comp in f["components"]]
    outs = []
    for j, c in enumerate(f["cols"]):
        outs.append(sum((F.lit(float(f["components"][i][j])) * z[i] for i in range(len(z))), F.lit(0.0)).alias(c))
    return df.select(*[qcol(c) for c in keep], *outs)


def reconstruction_mse(df: DataFrame, cols: Sequence[str], k: int) -> float:
    """Mean squared error between the standardised data and its k-axis reconstruction."""
    f = fit_pca(df, cols, k)
    exprs, _ = _std_exprs_from(f)
    z = [sum((F.lit(float(w)) * x for w, x in zip(comp, exprs)), F.lit(0.0)) for comp in f["components"]]
    err = F.lit(0.0)
    for j, x in enumerate(exprs):
        xh = sum((F.lit(float(f["components"][i][j])) * z[i] for i in range(len(z))), F.lit(0.0))
        err = err + (x - xh) * (x - xh)
    return float(df.agg(F.avg(err / F.lit(len(exprs)))).first()[0])


def project_2d(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Two unwhitened principal components plus the label columns (data under the scatter)."""
    return project(df, fit_pca(df, cols, 2), whiten=False, keep=keep)
