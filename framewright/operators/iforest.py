"""Isolation-forest outlier flag (inventory #88), following the published algorithm
(Liu, Ting & Zhou, 2008): random axis-parallel splits on small sub-samples, anomaly
score 2^(-E[h(x)] / c(psi)).

Spark does the data work: every row has one place on a ring of row hashes, and a tree's sub-sample is the
``max_samples`` rows that follow the tree's own offset (all rows, if fewer). So one hash per row decides, samples
overlap only where the table is small, and a large table's rows mostly drop out at once. Trees are grown in
parallel with ``applyInPandas`` grouped by tree id, and the forest — at most n_trees x (2 psi - 1)
nodes, a fixed bound — is broadcast. The score of a single column is constant between the forest's
thresholds, so it is looked up; rows of several columns walk the trees in a vectorised Pandas UDF.
The cut is the exact (1 - contamination) quantile of the scores.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import qcol, quantiles

EULER_GAMMA = 0.5772156649015329


def average_path_length(n) -> np.ndarray:
    """c(n): average path length of an unsuccessful search in a binary search tree."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Nodes (node, feature, threshold, left, right, size, depth) of one isolation tree."""
    nodes = []
    stack = [(0, np.arange(len(x)), 0)]
    next_id = 1
    while stack:
        nid, idx, depth = stack.pop()
        sub = x[idx]
        if depth >= max_depth or len(idx) <= 1:
            nodes.append((nid, -1, 0.0, -1, -1, len(idx), depth))
            continue
        lo, hi = sub.min(0), sub.max(0)
        usable = np.nonzero(hi > lo)[0]
        if len(usable) == 0:
            nodes.append((nid, -1, 0.0, -1, -1, len(idx), depth))
            continue
        f = int(rng.choice(usable))
        thr = float(rng.uniform(lo[f], hi[f]))
        left, right = next_id, next_id + 1
        next_id += 2
        nodes.append((nid, f, thr, left, right, len(idx), depth))
        stack.append((left, idx[sub[:, f] < thr], depth + 1))
        stack.append((right, idx[sub[:, f] >= thr], depth + 1))
    return nodes


def _grow_kernel(seed: int, max_depth: int):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = np.stack(pdf["x"].to_numpy()).astype(float)
        nodes = _grow(x, np.random.default_rng(seed * 1_000_003 + tree), max_depth)
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right", "size", "depth"])
        out.insert(0, "tree", tree)
        return out
    return fn


def _score_batch(x: np.ndarray, forest: list[dict], c_psi: float) -> np.ndarray:
    depth_sum = np.zeros(len(x))
    for t in forest:
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(t["max_depth"] + 1):
            feat = t["feature"][node]
            internal = feat >= 0
            if not internal.any():
                break
            xv = x[np.arange(len(x)), np.where(internal, feat, 0)]
            go_left = xv < t["threshold"][node]
            nxt = np.where(go_left, t["left"][node], t["right"][node])
            node = np.where(internal, nxt, node)
        depth_sum += t["depth"][node] + average_path_length(t["size"][node])
    return np.power(2.0, -(depth_sum / len(forest)) / c_psi)


def isolation_forest_scores(df: DataFrame, cols: Sequence[str], key: str, n_trees: int = 100,
                            max_samples: int = 256, seed: int = 42, out: str = "iforest_score") -> DataFrame:
    """Anomaly score in (0, 1] per row (rows with a null feature get null)."""
    cols = list(cols)
    x = F.array(*[qcol(c).cast("double") for c in cols])
    base = df.where(F.forall(x, lambda v: v.isNotNull()))
    n = base.count()
    if n == 0:
        return df.withColumn(out, F.lit(None).cast("double"))
    psi = min(max_samples, n)
    width = min(1.0, 3.0 * psi / n)  # of the ring, behind a tree's offset
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), qcol(key).cast("string")))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
    keyed = base.select(qcol(key).cast("string").alias("__k"), x.alias("x"), place.alias("__u"))
    back = min(n_trees - 1, int(width * n_trees) + 1)
    near = keyed.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(back))))
    near = near.withColumn("tree", F.pmod(F.floor(F.col("__u") * n_trees) - F.col("tree"), F.lit(n_trees)).cast("int"))
    near = near.withColumn("__u", F.pmod(F.col("__u") - F.col("tree") / F.lit(float(n_trees)), F.lit(1.0))).where(F.col("__u") <= width)
    w = Window.partitionBy("tree").orderBy("__u", "__k")
    sample = near.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= psi)
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    nodes = (sample.select("tree", "x").groupBy("tree")
             .applyInPandas(_grow_kernel(seed, max_depth),
                            "tree int, node long, feature long, threshold double, left long, right long, "
                            "size long, depth long")).toPandas()
    forest = []
    for _, g in nodes.groupby("tree"):
        g = g.sort_values("node")
        size = int(g["node"].max()) + 1
        arr = {k: np.zeros(size, dtype=float if k == "threshold" else np.int64)
               for k in ["feature", "threshold", "left", "right", "size", "depth"]}
        for k in arr:
            arr[k][g["node"].to_numpy()] = g[k].to_numpy()
        arr["max_depth"] = int(g["depth"].max())
        forest.append(arr)
    c_psi = float(average_path_length([psi])[0]) or 1.0
    if len(cols) == 1:
        cuts = np.unique(np.concatenate([t["threshold"][t["feature"] >= 0] for t in forest]))
        at = np.concatenate([[np.nextafter(cuts[0], -np.inf)] if len(cuts) else [0.0], cuts])  # one value of every stretch
        bc = df.sparkSession.sparkContext.broadcast((cuts, _score_batch(at[:, None], forest, c_psi)))

        @F.pandas_udf("double")
        def look_up(v: pd.Series) -> pd.Series:
            cuts, scores = bc.value
            v = v.to_numpy(dtype=float)
            return pd.Series(np.where(np.isnan(v), np.nan, scores[np.searchsorted(cuts, v, side="right")]))

        value = qcol(cols[0]).cast("double")
        return df.withColumn(out, F.when(value.isNotNull(), look_up(value)))
    bc = df.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(v: pd.Series) -> pd.Series:
        xs = np.stack(v.to_numpy()).astype(float)
        return pd.Series(_score_batch(xs, bc.value, c_psi))

    return df.withColumn(out, F.when(F.forall(x, lambda v: v.isNotNull()), score(x)))


def isolation_forest_flag(df: DataFrame, col: str | Sequence[str], key: str, contamination: float = 0.05,
                          seed: int = 42, n_trees: int = 100, max_samples: int = 256) -> DataFrame:
    """0/1 column ``outlier_iforest_<col>``: score above the (1 - contamination) quantile."""
    cols = [col] if isinstance(col, str) else list(col)
    name = f"outlier_iforest_{'_'.join(cols)}"
    scored = isolation_forest_scores(df, cols, key, n_trees, max_samples, seed, "__score")
    # the scores alone are cached for the cut; rows and flags stay lazy
    scores = scored.select("__score").persist()
    cut = quantiles(scores, ["__score"], [1.0 - contamination])["__score"][0]
    scores.unpersist()
    flag = F.coalesce(F.col("__score") > F.lit(cut), F.lit(False)) if cut is not None else F.lit(False)
    return scored.withColumn(name, flag.cast("int")).drop("__score")
