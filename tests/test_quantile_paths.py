"""Exact quantiles: settled and cut brackets, ties, missed sketches, bounded collection."""

import numpy as np
import pytest

from framewright.functions import stats
from framewright.functions.stats import order_statistics, quantiles

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


def frame(spark, vals):
    return spark.createDataFrame([(float(v), int(i % 7)) for i, v in enumerate(vals)], "x double, y int")


def mixed(n, seed=21):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.exponential(size=n // 2), np.full(n // 4, 1.25), rng.normal(size=n - n // 2 - n // 4)]).round(5)


@pytest.mark.parametrize("few", [1, 20, 150, 5000])
def test_quantiles_match_numpy(spark, monkeypatch, few):
    monkeypatch.setattr(stats, "FEW", few)
    monkeypatch.setattr(stats, "ACCURACY", 400)
    vals, trace = mixed(10_000), []
    got = quantiles(frame(spark, vals), ["x", "y"], PROBS, trace=trace)
    assert np.allclose(got["x"], np.quantile(vals, PROBS), rtol=0, atol=1e-12)
    assert np.allclose(got["y"], np.quantile(np.arange(10_000) % 7, PROBS), rtol=0, atol=1e-12)
    assert max(trace) <= 3 * few * 2 * len(PROBS)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 4999, 5001, 6000])
def test_small_and_bordering_sizes(spark, n):
    vals = mixed(n, seed=n) if n > 3 else np.arange(n) * 1.5
    got = quantiles(frame(spark, vals), ["x"], PROBS)["x"]
    assert np.allclose(got, np.quantile(vals, PROBS), rtol=0, atol=1e-12)


def test_nulls_infinities_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (float("inf"), None), (float("-inf"), None), (2.0, None)], "x double, z double")
    assert quantiles(df, ["x", "z"], [0.0, 0.5, 1.0]) == {"x": [float("-inf"), 1.5, float("inf")], "z": [None] * 3}


def test_a_missed_sketch_is_widened(spark, monkeypatch):
    monkeypatch.setattr(stats, "FEW", 30)
    monkeypatch.setattr(stats, "MARGIN", -40)  # first brackets that can't hold their rank
    vals = mixed(8_000)
    assert np.allclose(quantiles(frame(spark, vals), ["x"], [0.3, 0.6])["x"], np.quantile(vals, [0.3, 0.6]), rtol=0, atol=1e-12)


def test_ranks(spark):
    vals = np.sort(mixed(3_000))
    got = order_statistics(frame(spark, vals), {"x": [0, 17, 1500, 2999, 3000, -1]})
    assert got == {("x", k): vals[k] for k in (0, 17, 1500, 2999)}


def test_few_values_are_collected_of_many(spark):
    df, trace = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet"), []
    got = quantiles(df, ["l_extendedprice", "l_quantity", "l_discount"], [0.25, 0.5, 0.75], trace=trace)
    want = [float(v) for v in df.selectExpr("percentile(cast(l_extendedprice as double), array(0.25, 0.5, 0.75)) as p").first().p]
    assert np.allclose(got["l_extendedprice"], want) and len(trace) == 1 and trace[0] <= 3_000
