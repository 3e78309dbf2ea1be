"""DBSCAN against brute force: 1-D, 2-D with a hot duplicate value, 3-D, wider vectors on principal axes;
known core rows, noise labels and the parameter search."""

import numpy as np
import pytest

from framewright.operators import cluster as CL

from .test_neighbours_cluster import _dbscan_brute


def _frame(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(len(x))], "id long, x array<double>")


@pytest.mark.parametrize("case", ["hot_duplicates_2d", "line_1d", "blobs_3d", "blobs_3d_on_2", "wide_5d"])
def test_dbscan_against_brute_force(spark, case):
    rng = np.random.default_rng(7)
    grid_dims = 2
    if case == "hot_duplicates_2d":
        x = np.vstack([np.full((120, 2), 1.5), rng.normal(size=(240, 2)) * 1.2])
        eps, ms = 0.4, 6
    elif case == "line_1d":
        x = np.concatenate([rng.uniform(0, 3, 150), rng.uniform(6, 7, 60), [20.0]])[:, None]
        eps, ms = 0.15, 4
    elif case.startswith("blobs_3d"):
        c = rng.uniform(-4, 4, size=(3, 3))
        x = c[rng.integers(0, 3, 300)] + rng.normal(scale=0.5, size=(300, 3))
        eps, ms, grid_dims = 0.6, 5, 3 if case == "blobs_3d" else 2
    else:
        c = rng.uniform(-4, 4, size=(3, 5))
        x = c[rng.integers(0, 3, 250)] + rng.normal(scale=0.5, size=(250, 5))
        eps, ms = 1.0, 5
    got = CL.dbscan(_frame(spark, x), "x", "id", eps=eps, min_samples=ms, grid_dims=grid_dims, chunk_rows=64)
    labels = got.orderBy("id").toPandas()["cluster"].to_numpy()
    assert list(labels) == list(_dbscan_brute(x, eps, ms))


def test_dbscan_of_no_core_rows_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [9.0, 0.0]), (3, None), (4, [None, 1.0])], "id long, x array<double>")
    assert [r.cluster for r in CL.dbscan(df, "x", "id", eps=1.0, min_samples=2).collect()] == [-1] * 4
    assert CL.dbscan(df.limit(0), "x", "id", eps=1.0).count() == 0
    one = CL.dbscan(df, "x", "id", eps=1.0, min_samples=1)
    assert {r.id: r.cluster for r in one.collect()} == {1: 0, 2: 1, 3: -1, 4: -1}
    assert {r.id: r.cluster for r in CL.relabel_noise(one).collect()} == {1: 0, 2: 1, 3: 2, 4: 2}


def test_search_reads_one_neighbour_table(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(0, 0.3, (80, 2)), rng.normal(3, 0.3, (60, 2)), rng.uniform(-2, 5, (15, 2))])
    got = CL.dbscan_grid_search(_frame(spark, x), "x", "id", [0.3, 0.6], [1, 4]).collect()
    assert len(got) == 4
    for r in got:
        want = _dbscan_brute(x, r.eps, r.min_samples)
        assert r.n_clusters == len(set(want) - {-1}) and r.noise_ratio == pytest.approx(np.mean(np.array(want) == -1))
        assert (r.silhouette is not None) == (1 < r.n_clusters < len(x))
