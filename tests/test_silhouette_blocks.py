"""The exact silhouette shuffles every row a bounded number of times, whatever the number of rows."""

import numpy as np

from framewright.operators import evaluate as EV


def test_blocks_are_bounded_until_a_block_is_full():
    assert EV.silhouette_blocks(900) == 1 and EV.silhouette_blocks(5_000) == 5
    assert EV.silhouette_blocks(40_000) == EV.silhouette_blocks(560_000) == EV.silhouette_blocks(1_000_000) == 16
    assert EV.silhouette_blocks(6_553_600) == 100


def test_value_over_tiles_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 3)).astype("float32")
    label = np.where(np.arange(1500) < 1300, 0, np.arange(1500) % 3)
    df = spark.createDataFrame([(i, int(c), [float(v) for v in row]) for i, (c, row) in enumerate(zip(label, x, strict=True))],
                               "id long, label int, x array<float>")
    got = EV.silhouette_exact(df, "x", "label", "id", block_rows=20)
    x = x.astype(float)
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    mean = np.stack([d[:, label == c].sum(1) / (label == c).sum() for c in range(3)], 1)
    n = np.bincount(label)[label]
    a = np.array([d[i, label == label[i]].sum() / (n[i] - 1) for i in range(len(x))])
    b = np.array([min(mean[i, c] for c in range(3) if c != label[i]) for i in range(len(x))])
    assert abs(got - np.mean((b - a) / np.maximum(a, b))) < 1e-6
