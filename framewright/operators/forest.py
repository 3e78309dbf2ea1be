"""Random forest regression on counts, for large tables whose feature vectors take few values (inventory #150).

The trees are those of ``pyspark.ml``: every row is drawn by a Poisson number of mean 1 for every tree, columns are cut into 32 bins at
most by Spark's rule, a node looks at a third of the columns, splits by variance, down to depth 5. A split only needs the sums of
the drawn rows by bin. So the rows are read once: a task draws for its rows and adds (rows, label, squared label) for every tree and
binned vector (cell). Trees then grow from these sums, each in a task of its own. Spark's own forest reads all rows
once a level and keeps a number per row and tree meanwhile. The random numbers are other ones than Spark's."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import qcol

ROWS, CELLS = 1 << 21, 1 << 15  # more rows and at most so many different vectors: else Spark's forest
BINS, DEPTH = 32, 5
HELD, SLICE = 1 << 16, 1 << 12  # rows that are sorted, and that are added up, at once

_CDF = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])
_SLOT = np.searchsorted(_CDF, np.arange(1 << 16) / (1 << 16), "right").astype(np.uint8)
_OPEN = 255  # a sixteen-bit slot that more than one number shares
_SLOT[_SLOT != np.searchsorted(_CDF, np.arange(1, (1 << 16) + 1) / (1 << 16), "left")] = _OPEN


def poisson_1(rng: np.random.Generator, n: int) -> np.ndarray:
    """Poisson numbers of mean 1 by inversion: the first sixteen bits of a uniform number settle nearly all of them."""
    slot = np.frombuffer(rng.bytes(2 * n), dtype=np.uint16)
    out = _SLOT[slot]
    left = np.flatnonzero(out == _OPEN)
    out[left] = np.searchsorted(_CDF, (slot[left] + rng.random(len(left))) / (1 << 16), "right")
    return out


def cuts_of(values: np.ndarray, counts: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Thresholds of a column with these values (sorted) and counts, by Spark's rule: between all values if they are few, else
    where the running count comes nearest to equal shares."""
    middle = (values[1:] + values[:-1]) / 2
    if len(middle) < bins:
        return middle
    run, share, out = np.cumsum(counts), counts.sum() / bins, []
    for i in range(1, len(values)):
        want = share * (len(out) + 1)
        if abs(run[i - 1] - want) < abs(run[i] - want):
            out.append(middle[i - 1])
    return np.array(out)


def grow(bins: np.ndarray, width: Sequence[int], sums: np.ndarray, rng: np.random.Generator, per_node: int, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(column, bin, mean) of every node of a tree, -1 for the column of a leaf; node i has the children 2i + 1 (bins up to ``bin``) and
    2i + 2. ``bins`` are the cells' (cells, columns), ``sums`` their (rows, label, squared label)."""
    size = 2 ** (depth + 1) - 1
    column, cut, mean = np.full(size, -1), np.zeros(size, dtype=np.int64), np.zeros(size)
    cells = [np.flatnonzero(sums[0])] + [None] * (size - 1)
    noise = lambda s: np.maximum(s[2] - s[1] * s[1] / np.maximum(s[0], 1), 0.0)
    for node in range(size):
        here = cells[node]
        if here is None or not len(here):
            continue
        whole = sums[:, here].sum(1)
        mean[node] = whole[1] / whole[0]
        if 2 * node + 2 >= size:
            continue
        best = 0.0
        for c in np.sort(rng.permutation(len(width))[:per_node]):
            by = np.stack([np.bincount(bins[here, c], weights=s[here], minlength=width[c]) for s in sums])
            low = np.cumsum(by, axis=1)[:, :-1]
            high = whole[:, None] - low
            gain = np.where((low[0] >= 1) & (high[0] >= 1), noise(whole) - noise(low) - noise(high), -1.0)
            if len(gain) and gain.max() > best:
                best, column[node], cut[node] = gain.max(), c, gain.argmax()
        if column[node] >= 0:
            left = bins[here, column[node]] <= cut[node]
            cells[2 * node + 1], cells[2 * node + 2] = here[left], here[~left]
    return column, cut, mean


class CountedForest:
    def __init__(self, cuts: list[np.ndarray], trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]], features: list[str]):
        self.cuts, self.trees, self.features = cuts, trees, features

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The mean of the trees' predictions for rows of features; equal binned rows are predicted once."""
        binned = np.stack([np.searchsorted(c, x[:, i], "left") for i, c in enumerate(self.cuts)], axis=1)
        some, of = np.unique(binned, axis=0, return_inverse=True)
        out = np.zeros(len(some))
        for column, cut, mean in self.trees:
            node = np.zeros(len(some), dtype=np.int64)
            for _ in range(int(math.log2(len(mean) + 1)) - 1):
                c = column[node]
                down = 2 * node + 1 + (some[np.arange(len(some)), c] > cut[node])
                node = np.where(c >= 0, down, node)
            out += mean[node]
        return (out / len(self.trees))[of.ravel()]

    def transform(self, df: DataFrame, label: str) -> DataFrame:
        """(prediction, label) of every row."""
        rows = df.select(*[qcol(c).cast("double") for c in self.features], qcol(label).cast("double").alias("__y"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns[:-1]], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(self.predict(x)), b.columns[-1]], names=["prediction", "__y"])

        return rows.mapInArrow(run, "prediction double, __y double").withColumnRenamed("__y", label)


def fit(df: DataFrame, features: Sequence[str], label: str, trees: int, seed: int, rows: int = ROWS, cells: int = CELLS) -> CountedForest | None:
    """The forest of ``df`` (no nulls), or None for tables of at most ``rows`` rows or more than about ``cells`` different vectors."""
    names, spark = [f"__f{i}" for i in range(len(features))], df.sparkSession
    data = df.select(*[qcol(c).cast("double").alias(n) for c, n in zip(features, names, strict=True)], qcol(label).cast("double").alias("__y"))
    seen = data.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(*names)).alias("d")).first()
    if seen["n"] <= rows or seen["d"] > cells:
        return None
    vectors = data.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).toPandas()
    cuts = []
    for n in names:
        by = vectors.groupby(n)["n"].sum().sort_index()
        cuts.append(cuts_of(by.index.to_numpy(dtype=float), by.to_numpy()))
    width = [len(c) + 1 for c in cuts]
    binned = lambda x: np.stack([np.searchsorted(c, x[:, i], "left") for i, c in enumerate(cuts)], axis=1)
    # cells by number: vectors in order of their bins
    known = np.unique(binned(vectors[names].to_numpy(dtype=float)), axis=0)
    place, total = [], 1
    for w in reversed(width):
        place.insert(0, total)
        total *= w
    if total >= 1 << 62:
        return None
    codes = known @ np.array(place)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rng, sums = np.random.Generator(np.random.SFC64([seed, part])), np.zeros((3, len(codes), trees))
        held, n = [], 0

        def add() -> None:
            x = np.concatenate(held)
            cell = np.searchsorted(codes, binned(x[:, :-1]) @ np.array(place))
            order = np.argsort(cell, kind="stable")
            for lo in range(0, len(x), SLICE):
                some = order[lo:lo + SLICE]
                at, y = cell[some], x[some, -1:]
                starts = np.flatnonzero(np.diff(at, prepend=-1))
                drawn = poisson_1(rng, len(some) * trees).reshape(-1, trees).astype(float)
                for i in range(3):
                    sums[i, at[starts]] += np.add.reduceat(drawn, starts, axis=0)
                    if i < 2:
                        drawn *= y

        for b in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1))
            n += b.num_rows
            if n >= HELD:
                add()
                held, n = [], 0
        if n:
            add()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(trees), pa.int32()), pa.array([part] * trees, pa.int32()),
                                          pa.array([sums[:, :, t].tobytes() for t in range(trees)], pa.binary())], names=["tree", "part", "sums"])

    per_node = math.ceil(len(features) / 3) if trees > 1 else len(features)

    def tree(pdf: pd.DataFrame) -> pd.DataFrame:
        sums = sum(np.frombuffer(s).reshape(3, -1) for s in pdf.sort_values("part")["sums"])
        t = int(pdf["tree"].iloc[0])
        column, cut, mean = grow(known, width, sums, np.random.default_rng([seed, t, 1]), per_node)
        return pd.DataFrame({"tree": [t], "col": [column.tolist()], "cut": [cut.tolist()], "mean": [mean.tolist()]})

    tasks = 4 * spark.sparkContext.defaultParallelism  # a task's sums of all trees are one row a tree
    grown = (data.coalesce(tasks).mapInArrow(draw, "tree int, part int, sums binary").groupBy("tree")
             .applyInPandas(tree, "tree int, col array<int>, cut array<int>, mean array<double>").orderBy("tree").collect())
    return CountedForest(cuts, [tuple(np.array(r[c]) for c in ("col", "cut", "mean")) for r in grown], list(features))
