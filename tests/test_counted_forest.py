"""The forest grown from counts against Spark's and against a plain tree."""

import numpy as np
import pytest
from pyspark.ml import regression

from framewright.operators import forest as FO
from framewright.operators import model as M


def _table(spark, n=6000):
    return spark.range(n).selectExpr("id", "double(id % 50) as a", "id * 7 % 11 / 100D as b", "id * 13 % 9 / 100D as c").selectExpr(
        "*", "a * a + 900 * b + rand(3) * 100 as y").repartition(3, "id")


def test_large_tables_of_few_vectors_grow_from_counts(spark, monkeypatch):
    df = _table(spark)
    want = {r.model: r for r in M.regression_compare(df, ["a", "b", "c"], "y", "id", trees=60).collect()}
    monkeypatch.setattr(FO.fit, "__defaults__", (1000, FO.CELLS))
    monkeypatch.setattr(regression, "RandomForestRegressor", None)  # Spark's forest isn't grown
    got = {r.model: r for r in M.regression_compare(df, ["a", "b", "c"], "y", "id", trees=60).collect()}
    again = {r.model: r for r in M.regression_compare(df, ["a", "b", "c"], "y", "id", trees=60).collect()}
    assert abs(got["random_forest"].r2 - want["random_forest"].r2) < 0.06 and want["random_forest"].r2 > 0.5
    assert got["linear_regression"] == want["linear_regression"] and got["knn_regression"] == want["knn_regression"]
    assert again["random_forest"] == got["random_forest"]


def test_other_tables_are_left_to_spark(spark):
    df = _table(spark)
    assert FO.fit(df, ["a", "b"], "y", 3, 1) is None  # few rows
    assert FO.fit(df, ["a", "y"], "c", 3, 1, rows=10, cells=1000) is None  # many vectors
    assert len(FO.fit(df, ["a", "b"], "y", 3, 1, rows=10).trees) == 3


def _plain(x, y, level=0):
    """A node's rows of a plain regression tree: the mean, or the best cut and both sides."""
    best = (1e-9, None)
    for c in range(x.shape[1]):
        for v in np.unique(x[:, c])[:-1]:
            left = x[:, c] <= v
            gain = y.var() * len(y) - y[left].var() * left.sum() - y[~left].var() * (~left).sum()
            best = max(best, (gain, (c, v)), key=lambda z: z[0])
    if level == FO.DEPTH or best[1] is None:
        return lambda r: y.mean()
    c, v = best[1]
    low, high = _plain(x[x[:, c] <= v], y[x[:, c] <= v], level + 1), _plain(x[x[:, c] > v], y[x[:, c] > v], level + 1)
    return lambda r: low(r) if r[c] <= v else high(r)


@pytest.mark.parametrize("seed", range(4))
def test_a_tree_of_all_columns_is_the_plain_tree(seed):
    r = np.random.default_rng(seed)
    x = np.column_stack([r.integers(0, 9, 400), r.integers(0, 5, 400), r.integers(0, 2, 400)])
    y = r.normal(size=400) + 3 * x[:, 0] * (x[:, 1] > 2)
    cells, at = np.unique(x, axis=0, return_inverse=True)
    sums = np.stack([np.bincount(at.ravel(), weights=w) for w in (np.ones(400), y, y * y)])
    tree = FO.grow(cells, [9, 5, 2], sums, r, per_node=3)
    forest, plain = FO.CountedForest([np.arange(w - 1) + 0.5 for w in (9, 5, 2)], [tree], ["a", "b", "c"]), _plain(x, y)
    assert np.allclose(forest.predict(x.astype(float)), [plain(v) for v in x])


def test_cuts_and_draws():
    assert FO.cuts_of(np.array([1.0]), np.array([5])).tolist() == []
    assert FO.cuts_of(np.array([1.0, 2.0, 4.0]), np.array([5, 1, 1])).tolist() == [1.5, 3.0]
    cuts = FO.cuts_of(np.arange(1000.0), np.ones(1000, dtype=int))
    assert len(cuts) == FO.BINS - 1 and abs(np.diff(cuts) - 1000 / 32).max() <= 1
    drawn = np.bincount(FO.poisson_1(np.random.default_rng(1), 4_000_000), minlength=9) / 4e6
    assert np.allclose(drawn[:9], np.diff(FO._CDF[:9], prepend=0), atol=1e-3) and drawn[7] > 0
