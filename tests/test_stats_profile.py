import math

import numpy as np
import pytest

from framewright.functions.stats import dagostino_k2, order_statistics, quantiles
from framewright.operators import profile as P


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    vals = rng.normal(size=5000).round(3).tolist()
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = quantiles(df, ["x"], [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0])["x"]
    exp = np.quantile(np.array(vals), [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0])  # linear interpolation
    assert np.allclose(got, exp, rtol=0, atol=1e-12)


def test_quantile_refinement_path(spark):
    # a tiny collect limit forces the sketch-bracket-count refinement rounds
    rng = np.random.default_rng(3)
    vals = rng.integers(0, 50, size=20000).astype(float)  # heavy duplicates
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = order_statistics(df, {"x": [0, 137, 9999, 19999]})
    srt = np.sort(vals)
    for k in [0, 137, 9999, 19999]:
        assert got[("x", k)] == srt[k]


def test_quantiles_empty_and_all_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    assert quantiles(df, ["a"], [0.5])["a"] == [None]
    empty = spark.createDataFrame([], "a double")
    assert quantiles(empty, ["a"], [0.25, 0.75])["a"] == [None, None]


def test_dagostino_reference_values():
    # skew part on 1..8 and kurtosis part on 0..19 (published example values)
    x = np.arange(1, 9, dtype=float)
    n = len(x)
    m2 = ((x - x.mean()) ** 2).mean()
    g1 = ((x - x.mean()) ** 3).mean() / m2 ** 1.5
    g2 = ((x - x.mean()) ** 4).mean() / m2 ** 2 - 3
    zs, _, _, _ = dagostino_k2(g1, g2, n)
    assert zs == pytest.approx(1.0108048609177787, abs=1e-12)
    y = np.arange(20, dtype=float)
    m2 = ((y - y.mean()) ** 2).mean()
    g1 = ((y - y.mean()) ** 3).mean() / m2 ** 1.5
    g2 = ((y - y.mean()) ** 4).mean() / m2 ** 2 - 3
    _, zk, _, _ = dagostino_k2(g1, g2, len(y))
    assert zk == pytest.approx(-1.7058104152122062, abs=1e-12)


def test_duplicate_count_nulls_equal(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, None), (1, None), (2, "x")], "a int, b string")
    assert P.duplicate_row_count(df).first()[0] == 2


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 10]], "x double")
    rows = P.histogram_bins(df, "x", 5).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [2, 2, 0, 0, 1]
    assert sum(r["density"] * (r["upper"] - r["lower"]) for r in rows) == pytest.approx(1.0)


def test_classify_and_empty_frame(spark):
    df = spark.createDataFrame([("a", "p", 1.0), ("b", "q", 2.0)], "c1 string, c2 string, x double")
    kinds = {r.column_name: r.kind for r in P.classify_columns(df, threshold=1).collect()}
    assert kinds == {"c1": "nominal", "c2": "nominal", "x": "numeric"}
    empty = spark.createDataFrame([], "a double, c string")
    assert P.null_counts(empty).count() == 0
    assert P.table_summary(empty).first()["n_rows"] == 0


def test_skew_kurtosis_adjusted_matches_pandas(spark):
    import pandas as pd
    vals = [1.0, 2.0, 3.0, 4.0, 10.0, 2.5, 7.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = P.skew_kurtosis_table(df, ["x"]).first()
    s = pd.Series(vals)
    assert r["skew"] == pytest.approx(s.skew(), rel=1e-9)
    assert r["kurtosis"] == pytest.approx(s.kurt(), rel=1e-9)
    assert not math.isnan(r["skew"])


def test_quantiles_scale_path_matches_numpy(spark):
    rng = np.random.default_rng(11)
    vals = np.concatenate([rng.normal(size=6000), np.full(3000, 0.5)]).round(4)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = quantiles(df, ["x"], probs)["x"]
    assert np.allclose(got, np.quantile(vals, probs), rtol=0, atol=1e-12)
