"""Connected components: stars of each partition's edges, then alternating stars over all."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component root (smallest index) of each of n nodes: minima over the edges with pointer jumping until stable."""
    lab = np.arange(n)
    while True:
        old = lab.copy()
        np.minimum.at(lab, a, lab[b])
        np.minimum.at(lab, b, lab[a])
        while True:
            jumped = lab[lab]
            if np.array_equal(jumped, lab):
                break
            lab = jumped
        if np.array_equal(lab, old):
            return lab


EDGES_AT_ONCE = 1_000_000


def _contracted(batches):
    """The edges (u, v) of a partition as stars (member, smallest member), some million edges at a time."""
    held, rows = [], 0

    def stars():
        u, v = (np.concatenate([h[c] for h in held]) for c in (0, 1))
        ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = local_components(len(ids), at[:len(u)], at[len(u):])
        keep = root != np.arange(len(ids))
        return pd.DataFrame({"u": ids[keep], "v": ids[root[keep]]})

    for pdf in batches:
        held.append((pdf["u"].to_numpy(), pdf["v"].to_numpy()))
        rows += len(pdf)
        if rows >= EDGES_AT_ONCE:
            yield stars()
            held, rows = [], 0
    if rows:
        yield stars()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): every node of ``edges`` with the smallest node that it reaches.

    Each partition's edges shrink to stars first, at most one edge a node. Then alternating large-star and
    small-star rounds run until every edge points at a root. Each
    round is written to the shared folder. A round only takes minima per node (combined before
    the shuffle) and joins them back, so a hub with many neighbours is a skewed join that
    adaptive execution can split; no component meets in one task or on the driver."""
    u, v = F.col("u"), F.col("v")
    pairs = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).distinct()
    cur = written(pairs.mapInPandas(_contracted, "u long, v long").distinct(), "edges")

    def mark(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    seen = mark(cur)
    while seen[0]:
        both = cur.unionByName(cur.select(v.alias("u"), u.alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(low, "u").where(v > u).select(v.alias("u"), F.col("low").alias("v")).distinct()
        floor = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (large.join(floor, "u").where(v != F.col("low")).select(v.alias("u"), F.col("low").alias("v"))
                 .unionByName(floor.select("u", F.col("low").alias("v"))).distinct())
        cur = written(small, "edges")
        now = mark(cur)
        if now == seen:
            break
        seen = now
    return cur.select(u.alias("node"), v.alias("root")).unionByName(cur.select(v.alias("node"), v.alias("root"))).distinct()


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """vertices(id), edges(src, dst) -> (id, label), label = smallest id of the component."""
    e = edges.select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"))
    roots = components(e, "src", "dst")
    return (vertices.select("id").join(roots.withColumnRenamed("node", "id"), "id", "left")
            .select("id", F.coalesce("root", "id").alias("label")))
