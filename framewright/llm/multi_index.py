"""Embedding near-dedup by an inverted multi-index.

Unit vectors are cut into halves, and each half has its own codebook; the product of both codebooks
is a grid of cells. A vector lies in one cell and, by a multi-sequence order (sums of both halves'
squared distances to the centroids), visits the nearest cells until the target recall. There all
pairs are verified by exact cosine, block by block: blocks return counts of links and a
spanning forest, never the pairs.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import components, written
from .vectors import decode, sample_of


def codebook(x: np.ndarray, size: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's k-means on a bounded sample."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(size, len(x)), replace=False)]
    for _ in range(rounds):
        near = distances(x, c).argmin(axis=1)
        for j in np.unique(near):
            c[j] = x[near == j].mean(axis=0)
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances, each summed on its own, so a row's are the same in any batch."""
    return np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1)


class Grid:
    """Both codebooks, and how far beyond its nearest cell a vector must look."""

    def __init__(self, unit: np.ndarray, size: int, cosine: float, recall: float, seed: int):
        self.half = max(unit.shape[1] // 2, 1)
        self.books = [codebook(part, size, seed + i) for i, part in enumerate(self.halves(unit))]
        # what a partner at exactly the threshold would need: the sample, turned by that angle in random directions
        rng = np.random.default_rng(seed)
        turns = np.repeat(unit, max(1, 20_000 // len(unit)), axis=0)
        side = rng.normal(size=turns.shape)
        side -= (side * turns).sum(axis=1, keepdims=True) * turns
        side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-12)
        partner = cosine * turns + np.sqrt(1 - cosine**2) * side
        s, theirs = self.sums(turns), self.sums(partner).argmin(axis=1)
        self.margin = float(np.quantile(s[np.arange(len(s)), theirs] - s.min(axis=1), recall))

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, :self.half], x[:, self.half:]

    def sums(self, x: np.ndarray) -> np.ndarray:
        """Sequence value of every cell for every vector."""
        a, b = (distances(part, book) for part, book in zip(self.halves(x), self.books, strict=True))
        return (a[:, :, None] + b[:, None, :]).reshape(len(x), -1)

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(own cell, mask of visited cells) of every vector."""
        s = self.sums(x)
        return s.argmin(axis=1), s <= s.min(axis=1, keepdims=True) + self.margin


def forest(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """(node, smallest node that it reaches) for the ends of the edges (u, v)."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b, label = at[:len(u)], at[len(u):], np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return np.stack([nodes, nodes[label]], axis=1)
        label = new


NO_ID = 1 << 62  # vectors without any id are nodes from here on


def link(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label", cosine: float = 0.98,
         size: int = 16, recall: float = 0.9999, sample: int = 4096, block: int = 1024, seed: int = 5) -> DataFrame:
    """(id, n_links, component_id, kept), one row per row of ``df``.

    Vectors link when their labels are equal and not null and their cosine is at least ``cosine``.
    The codebooks and the margin come from a bounded sample; every row is indexed. The margin is such
    that a share ``recall`` of partners at exactly the threshold is reached from one side; a pair is
    found if either side reaches the other. Equal vectors of a label are one node with a weight;
    a full cell is cut into blocks of about ``block`` rows, and its visitors likewise, so a third of all
    rows in one cell is many tasks. Vectors that are null, zero or hold null or non-finite components link with nothing: 0
    links, their own component. Vectors of different lengths don't link; every length that occurs has a grid of its own. Rows that
    repeat an id are vectors of their own in ``n_links`` and share a component if of equal length. Rows without an id
    count like others; they keep a null component unless they reach an id (ids are below 2**62). An empty table gives no rows."""
    label = F.col(label_col).cast("string") if label_col else F.lit("")
    rows = df.select(F.col(id_col).alias("id"), label.alias("label"), F.col(vec_col).alias("vec"))
    has = F.coalesce(F.size("vec"), F.lit(-1))
    widths = sorted(r.w for r in rows.select(has.alias("w")).distinct().collect())  # the lengths that occur
    parts = [_link_width(rows.where(has == w) if len(widths) > 1 else rows, id_col, max(w, 0), cosine, size, recall, sample, block, seed) for w in widths or [0]]
    return functools.reduce(DataFrame.unionByName, parts)


def _link_width(rows: DataFrame, id_col: str, width: int, cosine: float, size: int, recall: float, sample: int, block: int, seed: int) -> DataFrame:
    """``link`` for (id, label, vec) rows of one length."""
    unit = sample_of(rows, "id", "vec", sample, width) if width else np.zeros((0, 1))
    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True) if len(unit) else unit
    grid = Grid(unit, size, cosine, recall, seed) if len(unit) else None

    def keyed(batches):
        for batch in batches:
            ok, x = decode(batch.column("vec"), width)
            raw = [v.tobytes() if good else None for good, v in zip(ok, x + 0.0, strict=True)]
            key = [hashlib.blake2b(r, digest_size=16).digest() if r else None for r in raw]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(key, pa.binary()), pa.array(raw, pa.binary())],
                                             ["id", "label", "key", "raw"])

    id_type = rows.schema["id"].dataType.simpleString()
    flat = written(rows.mapInArrow(keyed, f"id {id_type}, label string, key binary, raw binary"), "vectors")
    nodes = flat.where(F.col("key").isNotNull() & F.col("label").isNotNull()).groupBy("label", "key").agg(
        F.min("id").cast("long").alias("node"), F.count("*").alias("weight"), F.first("raw").alias("raw"))
    nodes = nodes.withColumn("node", F.coalesce("node", F.lit(NO_ID) + F.pmod(F.xxhash64("label", "key"), F.lit(NO_ID - 1))))

    def placed(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("raw").to_pylist()), dtype=np.float64).reshape(-1, width)
            own, seen = grid.visits(x / np.linalg.norm(x, axis=1, keepdims=True))
            bits = [b.tobytes() for b in np.packbits(seen, axis=1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32)), pa.array([np.flatnonzero(s).astype(np.int32) for s in seen], pa.list_(pa.int32())),
                                              pa.array(bits, pa.binary())], [*batch.schema.names, "cell", "cells", "bits"])

    def verified(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"node": [], "other": [], "links": []}, dtype="float64")
        if len(left) and len(right):
            x, y = (np.frombuffer(b"".join(f["raw"]), dtype=np.float64).reshape(-1, width) for f in (left, right))
            nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
            i, j = np.nonzero((x / nx[:, None]) @ (y / ny[:, None]).T >= cosine - 1e-9)
            u, v = left["node"].to_numpy(), right["node"].to_numpy()
            keep = np.zeros(len(i), dtype=bool)
            for a in range(0, len(i), 1 << 16):  # products of the pairs found, in pieces
                s = slice(a, a + (1 << 16))
                keep[s] = (x[i[s]] * y[j[s]]).sum(axis=1) / (nx[i[s]] * ny[j[s]]) >= cosine
            keep &= u[i] != v[j]
            i, j = i[keep], j[keep]
            if len(i):
                # the other side finds the pair as well if the resident visits the visitor's cell
                cell = left["cell"].to_numpy()[i]
                bits = np.frombuffer(b"".join(right["bits"]), dtype=np.uint8).reshape(len(right), -1)
                both = (bits[j, cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1
                wx, wy = left["weight"].to_numpy(), right["weight"].to_numpy()
                mine = np.bincount(i, wy[j], minlength=len(left))
                theirs = np.bincount(j, np.where(both, 0, wx[i]), minlength=len(right))
                trees = forest(u[i], v[j])  # (node, smallest) pairs
                trees = trees[trees[:, 0] != trees[:, 1]]
                out = pd.DataFrame({"node": np.concatenate([u[mine > 0], v[theirs > 0], trees[:, 0]]),
                                    "other": np.concatenate([np.full(int((mine > 0).sum() + (theirs > 0).sum()), -1), trees[:, 1]]),
                                    "links": np.concatenate([mine[mine > 0], theirs[theirs > 0], np.zeros(len(trees))])})
        return out.astype("int64")

    if grid is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").cast("long").alias("component_id"), F.lit(True).alias("kept"))
    cells = written(nodes.mapInArrow(placed, "label string, key binary, node long, weight long, raw binary, cell int, cells array<int>, bits binary"), "cells")
    visitors = cells.select("label", F.explode("cells").alias("at"), "node", "weight", "raw", "cell")
    parts = visitors.groupBy("label", "at").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    full = cells.groupBy("label", F.col("cell").alias("at")).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).join(parts, ["label", "at"])
    deal = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = visitors.join(full, ["label", "at"]).select("label", "at", "node", "weight", "raw", "cell", deal("parts", 1).alias("p"), spread("blocks").alias("b"))
    right = cells.withColumnRenamed("cell", "at").join(full, ["label", "at"]).select("label", "at", "node", "weight", "raw", "bits", deal("blocks", 2).alias("b"), spread("parts").alias("p"))
    right = right.toDF(*right.columns)  # columns of its own, as both sides come from one table
    by = ["label", "at", "b", "p"]
    found = written(left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(verified, "node long, other long, links long"), "links")
    roots = components(found.where("links = 0"), "node", "other").withColumnRenamed("root", "component_id")
    counts = found.where("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
    known = (cells.select("label", "key", "node", "weight").join(counts, "node", "left").join(roots, "node", "left")
             .select("label", "key", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component_id", "node").alias("component_id")))
    known = known.withColumn("component_id", F.when(F.col("component_id") < NO_ID, F.col("component_id")))
    own = F.col("id").cast("long")
    return flat.select("id", "label", "key").join(known, ["label", "key"], "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", own).alias("component_id"),
        (own == F.coalesce("component_id", own)).alias("kept"))
