"""The combinations of the parameter search run side by side, each as it would alone."""

import threading

import numpy as np

from framewright.operators import density as D


def test_combinations_run_side_by_side(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(c, 0.2, size=(25, 2)) for c in (0.0, 5.0)])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    alone = [r for eps in (0.3, 6.0) for r in D.dbscan_grid_search(df, ["a", "b"], "id", [eps], [4]).collect()]
    met, one = threading.Barrier(2), D.dbscan

    def both(*args, **kw):
        met.wait(60)  # one after the other, nobody would come
        return one(*args, **kw)

    monkeypatch.setattr(D, "dbscan", both)
    assert D.dbscan_grid_search(df, ["a", "b"], "id", [0.3, 6.0], [4]).collect() == alone
