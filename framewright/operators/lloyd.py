"""k-means of several starts and several k at once: every scan serves all of them.

Equal vectors are one weighted row. A scan gives each model's sums, weights and cost per cluster, combined by one
aggregate, so only k rows a model reach the driver. Starts are seeded by oversampling: two rounds in which every row is
drawn with a chance by its share of the cost so far (about 2 k rows a round and model), then weighted k-means++ on these.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .evaluate import feature_array

SLICE = 4_000_000  # differences held at a time


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of every row's nearest centre."""
    at, d2 = np.empty(len(x), np.int64), np.empty(len(x))
    step = max(1, SLICE // max(1, centres.size))
    for lo in range(0, len(x), step):
        all2 = ((x[lo:lo + step, None, :] - centres[None]) ** 2).sum(-1)
        at[lo:lo + step] = all2.argmin(1)
        d2[lo:lo + step] = all2.min(1)
    return at, d2


def _scan(points: DataFrame, models: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Per model (sums, weights, cost) of its clusters."""
    d, bc = models[0].shape[1], points.sparkSession.sparkContext.broadcast(models)

    def part(batches):
        sums = [np.zeros((len(c), d + 2)) for c in bc.value]
        for pdf in batches:
            if pdf.empty:
                continue
            x, w = np.stack(pdf["x"].to_numpy()).astype(float), pdf["w"].to_numpy(dtype=float)
            for total, centres in zip(sums, bc.value, strict=True):
                at, d2 = _nearest(x, centres)
                for i, v in enumerate([*(w * x.T), w, w * d2]):
                    total[:, i] += np.bincount(at, v, len(centres))
        yield pd.DataFrame([(m, c, *row) for m, total in enumerate(sums) for c, row in enumerate(total)], columns=["m", "c", *(f"s{i}" for i in range(d + 2))])

    names = [f"s{i}" for i in range(d + 2)]
    rows = points.select("x", "w").mapInPandas(part, ", ".join(["m int", "c int", *(f"{s} double" for s in names)]))
    out = [np.zeros((len(c), d + 2)) for c in models]
    for r in rows.groupBy("m", "c").agg(*[F.sum(s).alias(s) for s in names]).collect():
        out[r.m][r.c] = r[2:]
    bc.unpersist()
    return [(t[:, :d], t[:, d], float(t[:, d + 1].sum())) for t in out]


def _drawn(points: DataFrame, models: list[np.ndarray], chances: list[float], salt: int) -> list[np.ndarray]:
    """Rows drawn for each model with chance x weight x squared distance, by the row's own hash."""
    bc = points.sparkSession.sparkContext.broadcast((models, chances))

    def part(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            x, w = np.stack(pdf["x"].to_numpy()).astype(float), pdf["w"].to_numpy(dtype=float)
            h = pdf["h"].to_numpy().astype(np.uint64)
            for m, (centres, chance) in enumerate(zip(*bc.value, strict=True)):
                u = (h ^ np.uint64(salt * 1_000_003 + m)) * np.uint64(0x9E3779B97F4A7C15)
                u = ((u ^ (u >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(11)
                took = u / 2.0 ** 53 < chance * w * _nearest(x, centres)[1]
                if took.any():
                    yield pd.DataFrame({"m": m, "x": list(x[took])})

    rows = points.mapInPandas(part, "m int, x array<double>").collect()
    bc.unpersist()
    got: list[list] = [[] for _ in models]
    for r in sorted(rows, key=lambda r: (r.m, r.x)):
        got[r.m].append(r.x)
    return [np.array(g, dtype=float).reshape(-1, c.shape[1]) for g, c in zip(got, models, strict=True)]


def _plus_plus(x: np.ndarray, w: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Weighted k-means++ on the drawn rows, then some steps of Lloyd on them."""
    picks = [int(rng.choice(len(x), p=w / w.sum()))]
    d2 = ((x - x[picks[0]]) ** 2).sum(1)
    while len(picks) < k and (w * d2).sum() > 0:
        picks.append(int(rng.choice(len(x), p=w * d2 / (w * d2).sum())))
        d2 = np.minimum(d2, ((x - x[picks[-1]]) ** 2).sum(1))
    centres = x[picks].copy()
    for _ in range(10):
        at, _d = _nearest(x, centres)
        n = np.bincount(at, w, len(centres))
        sums = np.stack([np.bincount(at, w * v, len(centres)) for v in x.T], axis=1)
        centres = np.where(n[:, None] > 0, sums / np.where(n > 0, n, 1)[:, None], centres)
    return centres


def kmeans_starts(df: DataFrame, features, ks: Sequence[int], starts: int = 10, seed: int = 42, max_iter: int = 300,
                  tol: float = 1e-4) -> dict[int, tuple[np.ndarray, float]]:
    """{k: (centres, cost)} of the best of ``starts`` for every k. A model stops when its centres move by at most ``tol`` x
    the mean variance in all (squared), or after ``max_iter`` steps. Rows with nulls or NaN take no part; with
    fewer than k different vectors there are fewer centres; of an empty table, none."""
    x = feature_array(df, features)
    points = (df.select(x.alias("x")).where(F.col("x").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)))
              .groupBy("x").agg(F.count(F.lit(1)).cast("double").alias("w")).withColumn("h", F.xxhash64("x", F.lit(seed))).persist())
    first = points.orderBy("h", "x").limit(max(ks) * starts).collect()  # parameters bound it
    if not first:
        points.unpersist()
        return {k: (np.zeros((0, 0)), 0.0) for k in ks}
    head = np.array([r.x for r in first], dtype=float)
    names = [(k, s) for k in ks for s in range(starts)]
    sets = [head[[s * max(ks) % len(head)]] for k, s in names]
    sums, weight, _ = _scan(points, [np.zeros((1, head.shape[1]))])[0]
    spread = _scan(points, [sums / weight.sum()])[0][2] / weight.sum() / head.shape[1]
    for turn in range(2):
        costs = [c for *_, c in _scan(points, sets)]
        more = _drawn(points, sets, [2.0 * k / c if c > 0 else 0.0 for (k, _), c in zip(names, costs, strict=True)], turn)
        sets = [np.unique(np.vstack([a, b]), axis=0) for a, b in zip(sets, more, strict=True)]
    sets = [np.unique(np.vstack([c, head[:k]]), axis=0) if len(c) < k else c for (k, _), c in zip(names, sets, strict=True)]
    models = [_plus_plus(c, np.maximum(n, 1e-9), k, np.random.default_rng([seed, k, s]))
              for (k, s), c, (_, n, _c) in zip(names, sets, _scan(points, sets), strict=True)]
    live = list(range(len(models)))
    for _ in range(max_iter):
        still = []
        for i, (total, n, _c) in zip(live, _scan(points, [models[i] for i in live]), strict=True):
            new = np.where(n[:, None] > 0, total / np.where(n > 0, n, 1)[:, None], models[i])
            moved = float(((new - models[i]) ** 2).sum())
            models[i] = new
            if moved > tol * spread:
                still.append(i)
        live = still
        if not live:
            break
    best: dict[int, tuple[np.ndarray, float]] = {}
    for (k, _), centres, (*_s, cost) in zip(names, models, _scan(points, models), strict=True):
        if k not in best or cost < best[k][1]:
            best[k] = (centres[np.lexsort(centres.T[::-1])], cost)
    points.unpersist()
    return best
