"""Reduction operators against numpy on the standardised lineitem doubles (sf0.001)."""

import numpy as np
import pytest

from framewright.operators import reduce as RD

COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@pytest.fixture
def lineitem(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey", "l_linenumber", *COLS)
    x = df.orderBy("l_orderkey", "l_linenumber").toPandas()[COLS].to_numpy(float)
    return df, (x - x.mean(0)) / x.std(0)


def _fix(v):
    return v * np.sign(v[np.argmax(np.abs(v))])


def test_truncated_svd_matches_numpy(lineitem):
    df, x = lineitem
    out = RD.truncated_svd(df, COLS, 2, keep=["l_orderkey", "l_linenumber"]).orderBy("l_orderkey", "l_linenumber")
    got = out.toPandas()
    _, _, vt = np.linalg.svd(x, full_matrices=False)
    for i in range(2):
        assert np.allclose(got[f"svd_{i + 1}"].to_numpy(), x @ _fix(vt[i]), atol=1e-6)


def test_pca_ratios_projection_and_reconstruction(lineitem):
    df, x = lineitem
    cov = np.cov(x, rowvar=False)
    eigval, eigvec = np.linalg.eigh(cov)
    order = np.argsort(eigval)[::-1]
    ratios = eigval[order] / eigval.sum()
    table = RD.explained_variance_table(df, COLS).orderBy("component").toPandas()
    assert np.allclose(table["explained_variance_ratio"], ratios, atol=1e-9)
    assert RD.choose_components(df, COLS, 0.95) == int(np.searchsorted(np.cumsum(ratios), 0.95 - 1e-12) + 1)
    proj = RD.project_2d(df, COLS, keep=["l_orderkey", "l_linenumber"]).orderBy("l_orderkey", "l_linenumber")
    got = proj.toPandas()
    for i in range(2):
        assert np.allclose(got[f"pc_{i + 1}"].to_numpy(), x @ _fix(eigvec[:, order[i]]), atol=1e-6)
    w = np.array([_fix(eigvec[:, order[i]]) for i in range(2)])
    mse = ((x - (x @ w.T) @ w) ** 2).mean()
    assert RD.reconstruction_mse(df, COLS, 2) == pytest.approx(mse, rel=1e-6)
