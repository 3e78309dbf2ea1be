"""Distributed neighbour / density / silhouette code checked against brute force on
small fixtures."""

import numpy as np
import pytest

from framewright.operators import cluster as CL
from framewright.operators import evaluate as EV
from framewright.operators import neighbours as N


def _blobs(n=300, d=2, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.uniform(-5, 5, size=(4, d))
    lab = rng.integers(0, 4, size=n)
    x = centres[lab] + rng.normal(scale=0.6, size=(n, d))
    return x, lab


def _frame(spark, x, lab=None):
    rows = [(i, [float(v) for v in x[i]], int(lab[i]) if lab is not None else 0) for i in range(len(x))]
    return spark.createDataFrame(rows, "id long, x array<double>, label int")


def test_knn_join_exact(spark):
    x, _ = _blobs(250, 3)
    df = _frame(spark, x)
    got = N.knn_join(df, df, "x", 4, "id", "id", exclude_self=True, chunk_rows=64).toPandas()
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    ids = np.arange(len(x))
    for q in range(len(x)):
        exp = list(np.lexsort((ids, d[q]))[:4])
        assert list(got[got.qid == q].sort_values("rank").did) == exp


def test_impute_knn_nan_euclidean(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 3))
    mask = rng.random(x.shape) < 0.15
    x[mask] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in x[i]]) for i in range(len(x))]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double")
    out = N.impute_knn(df, ["a", "b", "c"], "k", n_neighbors=3, chunk_rows=32).orderBy("k").toPandas()
    cols = ["a", "b", "c"]
    for i in range(len(x)):
        for j, c in enumerate(cols):
            if not np.isnan(x[i, j]):
                assert out.loc[i, c] == pytest.approx(x[i, j])
                continue
            donors = [r for r in range(len(x)) if not np.isnan(x[r, j])]
            dist = []
            for r in donors:
                both = ~np.isnan(x[i]) & ~np.isnan(x[r])
                if both.sum() == 0:
                    continue
                dist.append((np.sqrt(3 / both.sum() * ((x[i, both] - x[r, both]) ** 2).sum()), r))
            best = sorted(dist)[:3]
            if not best:  # a row with no observed coordinate has no neighbour: stays missing
                assert np.isnan(out.loc[i, c])
                continue
            assert out.loc[i, c] == pytest.approx(np.mean([x[r, j] for _, r in best]))


def _dbscan_brute(x, eps, min_samples):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    nb = d <= eps
    core = nb.sum(1) >= min_samples
    comp = -np.ones(len(x), dtype=int)
    for s in np.nonzero(core)[0]:
        if comp[s] >= 0:
            continue
        stack = [s]
        comp[s] = s
        while stack:
            v = stack.pop()
            for u in np.nonzero(nb[v] & core)[0]:
                if comp[u] < 0:
                    comp[u] = s
                    stack.append(u)
    # component label = smallest core id; border = smallest label among core neighbours
    lab = -np.ones(len(x), dtype=int)
    for c in set(comp[core]):
        members = np.nonzero(comp == c)[0]
        lab[members] = members.min()
    for i in np.nonzero(~core)[0]:
        cands = [lab[u] for u in np.nonzero(nb[i] & core)[0]]
        if cands:
            lab[i] = min(cands)
    order = {v: k for k, v in enumerate(sorted(set(lab[lab >= 0])))}
    return np.array([order[v] if v >= 0 else -1 for v in lab])


def test_dbscan_matches_brute_force(spark):
    x, _ = _blobs(300, 2, seed=11)
    df = _frame(spark, x)
    got = CL.dbscan(df, "x", "id", eps=0.5, min_samples=5, chunk_rows=40).orderBy("id").toPandas()
    exp = _dbscan_brute(x, 0.5, 5)
    assert list(got["cluster"]) == list(exp)


def test_silhouette_and_centroid_metrics(spark):
    x, lab = _blobs(200, 3, seed=2)
    df = _frame(spark, x, lab)
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    s = []
    for i in range(len(x)):
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    got = EV.silhouette_exact(df, "x", "label", "id", block_rows=60)
    assert got == pytest.approx(np.mean(s), abs=1e-9)
    cent = np.array([x[lab == c].mean(0) for c in sorted(set(lab))])
    w = sum(((x[lab == c] - cent[k]) ** 2).sum() for k, c in enumerate(sorted(set(lab))))
    assert EV.inertia(df, "x", "label") == pytest.approx(w, rel=1e-9)
    g = x.mean(0)
    b = sum((lab == c).sum() * ((cent[k] - g) ** 2).sum() for k, c in enumerate(sorted(set(lab))))
    k, n = len(cent), len(x)
    assert EV.calinski_harabasz(df, "x", "label") == pytest.approx((b / (k - 1)) / (w / (n - k)), rel=1e-9)


def test_connected_components_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 101)], "src long, dst long")
    verts = spark.createDataFrame([(i,) for i in list(range(41)) + [100, 101, 200]], "id long")
    lab = {r.id: r.label for r in CL.connected_components(verts, edges).collect()}
    assert all(lab[i] == 0 for i in range(41))
    assert lab[100] == lab[101] == 100 and lab[200] == 200


def test_connected_components_distributed_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 30)] + [(100, 101), (101, 55)], "src long, dst long")
    verts = spark.createDataFrame([(i,) for i in list(range(31)) + [55, 100, 101, 200]], "id long")
    lab = {r.id: r.label for r in CL.connected_components(verts, edges).collect()}
    assert all(lab[i] == 0 for i in range(31))
    assert lab[100] == lab[101] == lab[55] == 55 and lab[200] == 200


def test_isolation_forest_flags_planted_outliers(spark):
    from framewright.operators.iforest import isolation_forest_flag

    rng = np.random.default_rng(0)
    vals = list(rng.normal(0, 1, size=980)) + list(rng.uniform(6, 30, size=20))
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "k long, v double")
    out = isolation_forest_flag(df, "v", "k", contamination=0.05, n_trees=50).toPandas()
    flagged = set(out[out["outlier_iforest_v"] == 1]["k"])
    assert 45 <= len(flagged) <= 55
    assert set(range(980, 1000)) <= flagged


def test_density_silhouette_keeps_noise_as_a_group(spark):
    import numpy as np
    r = np.random.default_rng(2)
    x = np.concatenate([r.normal(0, 0.3, (12000, 2)), r.normal(4, 0.3, (300, 2)), r.uniform(-5, 9, (60, 2))])
    label = np.repeat([0, 1, -1], [12000, 300, 60])
    df = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, label))], "id long, x array<double>, label int")
    s = []
    for v, c in zip(x[::50], label[::50]):
        d = {k: ((x[label == k] - v) ** 2).sum(1).mean() for k in (0, 1, -1)}
        n = (label == c).sum()
        a, b = d[c] * n / (n - 1), min(q for k, q in d.items() if k != c)
        s.append((b - a) / max(a, b))
    got = {r.metric: r.value for r in EV.evaluate_clusters(df, "x", "label", "dbscan").collect()}
    assert abs(got["silhouette"] - np.mean(s)) < 0.02 and got["n_clusters"] == 2


def test_null_prediction_is_an_error(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (0, 1), (None, None)], "t int, p int")
    assert sorted((r.t, r.p, r.error_rate) for r in EV.misclassified_rows(df, "t", "p").fillna(-1).collect()) == [(0, 1, 0.5), (1, -1, 0.5)]


def test_default_imputation_leaves_whole_columns_alone(spark):
    from framewright.operators import impute as IM
    big = 2**53 + 1
    df = spark.createDataFrame([(big, 1.0), (big, None), (big + 1, 3.0)], "k long, x double")
    for fn in (IM.impute_mean, IM.impute_median):
        assert dict(fn(df).dtypes) == {"k": "bigint", "x": "double"}
        assert sorted(r.x for r in fn(df).collect()) == [1.0, 2.0, 3.0]
    assert IM.column_modes(df, ["k"]) == {"k": big}
