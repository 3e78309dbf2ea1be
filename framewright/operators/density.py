"""DBSCAN as Spark jobs over a graph of grid cells (inventory #147).

Rows are put into cells of side eps / sqrt(m) on m coordinates (of wider vectors: on the top m principal axes). Every
cell has the bounding box of its rows in all coordinates, and cells whose boxes lie within eps of each other form
the cell graph, a table. Boxes that lie wholly within eps settle neighbour counts and links of whole cells at
once; only what they leave open is measured row by row, in chunks. It is one method at every size and width:

1. core rows: rows of the cells that a cell's neighbours wholly within eps already count for; else by exact counts;
2. links: core rows of a cell whose box is no wider than eps are one node, other core rows a node each. Nodes are linked by
   boxes, then by the outermost rows of two cells, and only cells still in different components are compared by rows;
3. components by alternating stars;
4. border rows take the smallest cluster among the core rows within eps; the others are noise (-1).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import qcol
from ..session import cut_lineage
from .graph import components, local_components
from .neighbours import (_cell, _chunked_pairs, _count_kernel, _offsets, _prepare, grid_basis, grid_dims_of, knn_join,
                         pairwise_distance, with_grid_coords)

HAIR = 1e-12  # boxes decide only what rounding can't turn


def _sides(pdf: pd.DataFrame):
    q, d = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
    if q.empty or d.empty:
        return q, d, None
    return q, d, pairwise_distance(np.stack(q["x"].to_numpy()).astype(float), np.stack(d["x"].to_numpy()).astype(float))


def _star_kernel(eps: float):
    """(id, root) of the rows of one chunk pair that lie in a local component of two or more: O(rows), never the pairs."""
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        q, d, dist = _sides(pdf)
        qi, di = np.nonzero(dist <= eps) if dist is not None else (np.zeros(0, int), np.zeros(0, int))
        a, b = q["id"].to_numpy()[qi], d["id"].to_numpy()[di]
        ids, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
        roots = local_components(len(ids), inv[:len(a)], inv[len(a):])
        keep = roots != np.arange(len(ids))
        # ids are sorted, so the root index is the smallest id of the component
        return pd.DataFrame({"id": ids[keep].astype("int64"), "root": ids[roots[keep]].astype("int64")})
    return fn


def _smallest_kernel(eps: float):
    """(qid, no): the smallest payload of the donors within eps."""
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        q, d, dist = _sides(pdf)
        if dist is None:
            return pd.DataFrame({"qid": pd.Series(dtype="int64"), "no": pd.Series(dtype="int64")})
        best = np.where(dist <= eps, d["payload"].to_numpy(dtype=float)[None, :], np.inf).min(1)
        ok = np.isfinite(best)
        return pd.DataFrame({"qid": q["id"].to_numpy()[ok].astype("int64"), "no": best[ok].astype("int64")})
    return fn


def _sum2(terms: Column, f) -> Column:
    return F.aggregate(terms, F.lit(0.0), lambda acc, s: acc + f(s) * f(s))


def _gap2(al: str, ah: str, bl: str, bh: str) -> Column:
    """Squared smallest distance of two boxes (a row is a box of no width)."""
    z = F.arrays_zip(F.col(al).alias("p"), F.col(ah).alias("q"), F.col(bl).alias("r"), F.col(bh).alias("s"))
    return _sum2(z, lambda t: F.greatest(t["r"] - t["q"], F.lit(0.0), t["p"] - t["s"]))


def _reach2(al: str, ah: str, bl: str, bh: str) -> Column:
    """Squared largest distance of two boxes."""
    z = F.arrays_zip(F.col(al).alias("p"), F.col(ah).alias("q"), F.col(bl).alias("r"), F.col(bh).alias("s"))
    return _sum2(z, lambda t: F.greatest(F.abs(t["s"] - t["p"]), F.abs(t["q"] - t["r"])))


class CellGraph:
    """Cells of the rows (id, x, c) with their boxes, and the pairs of cells within eps."""

    def __init__(self, rows: DataFrame, eps: float, m: int, ring: int, outermost: bool = False):
        d = len(rows.select("x").first()["x"])
        x = F.col("x")
        aggs = [F.count(F.lit(1)).alias("n"), F.min("id").alias("rep"),
                F.array(*[F.min(x[i]) for i in range(d)]).alias("lo"), F.array(*[F.max(x[i]) for i in range(d)]).alias("hi")]
        if outermost:  # the outermost rows on the first coordinates
            aggs.append(F.array(*[f(x, x[i]) for i in range(min(d, 4)) for f in (F.min_by, F.max_by)]).alias("out"))
        self.within, self.beyond = eps * eps * (1 - HAIR), eps * eps * (1 + HAIR)
        self.cells = rows.groupBy("c").agg(*aggs).withColumn("tight", _reach2("lo", "hi", "lo", "hi") <= self.within).persist()
        steps = F.array(*[F.array(*[F.lit(v).cast("long") for v in o]) for o in _offsets(m, ring)])
        around = F.explode(F.transform(steps, lambda o: F.zip_with(F.col("ac"), o, lambda p, q: p + q)))
        side = lambda s: self.cells.select(*[F.col(c).alias(s + c) for c in self.cells.columns])
        self.pairs = (side("a").withColumn("bc", around).join(side("b"), "bc")
                      .where(_gap2("alo", "ahi", "blo", "bhi") <= self.beyond)
                      .withColumn("sure", _reach2("alo", "ahi", "blo", "bhi") <= self.within).persist())

    def release(self) -> None:
        self.pairs.unpersist()
        self.cells.unpersist()


def _core(p: DataFrame, graph: CellGraph, eps: float, min_samples: int, chunk_rows: int) -> DataFrame:
    """(id, x, c) of the rows with at least ``min_samples`` rows within eps, themselves included."""
    have = graph.pairs.groupBy(F.col("ac").alias("c")).agg(F.sum(F.when(F.col("sure"), F.col("bn")).otherwise(0)).alias("have"))
    whole = p.join(have.where(F.col("have") >= min_samples), "c").select("id", "x", "c")
    short = have.where(F.col("have") < min_samples)
    asked = graph.pairs.where(~F.col("sure")).select(F.col("ac").alias("c"), F.col("bc").alias("g"), "blo", "bhi", "bn")
    visits = (p.join(short, "c").join(asked, "c").where(_gap2("x", "x", "blo", "bhi") <= graph.beyond)
              .withColumn("all", _reach2("x", "x", "blo", "bhi") <= graph.within))
    donors = p.select("id", F.col("c").alias("g"), "x", F.lit(None).cast("double").alias("payload"))
    measured = (_chunked_pairs(visits.where(~F.col("all")).select("id", "g", "x"), donors, chunk_rows)
                .groupBy("g", "qc", "dc").applyInPandas(_count_kernel(eps), "qid long, n long"))
    counts = (visits.where("all").select("id", F.col("bn").alias("n"))
              .unionByName(measured.select(F.col("qid").alias("id"), "n")).groupBy("id").agg(F.sum("n").alias("n")))
    enough = F.col("have") + F.coalesce("n", F.lit(0)) >= min_samples
    return whole.unionByName(p.join(short, "c").join(counts, "id", "left").where(enough).select("id", "x", "c"))


def _linked(core: DataFrame, graph: CellGraph, eps: float, chunk_rows: int) -> DataFrame:
    """(id, x, c, label): label is the smallest core id that the row reaches."""
    nodes = core.join(graph.cells.select("c", "rep", "tight"), "c").withColumn(
        "node", F.when(F.col("tight"), F.col("rep")).otherwise(F.col("id"))).select("id", "x", "c", "node").persist()
    both = F.col("atight") & F.col("btight")
    pairs = graph.pairs.where((F.col("arep") < F.col("brep")) | ((F.col("ac") == F.col("bc")) & ~F.col("atight")))
    near = lambda p, q: _sum2(F.arrays_zip(p.alias("p"), q.alias("q")), lambda t: t["p"] - t["q"]) <= graph.within
    met = F.col("sure") | F.exists("aout", lambda p: F.exists("bout", lambda q: near(p, q)))
    pairs = pairs.withColumn("met", both & met).persist()
    edges = pairs.where("met").select(F.col("arep").alias("a"), F.col("brep").alias("b"))
    roots = components(edges, "a", "b")
    root = lambda s: roots.select(F.col("node").alias(f"{s}rep"), F.col("root").alias(f"{s}root"))
    apart = F.coalesce("aroot", "arep") != F.coalesce("broot", "brep")
    left = pairs.where(~F.col("met")).join(root("a"), "arep", "left").join(root("b"), "brep", "left").where(~both | apart)
    asked = left.select(F.col("ac").alias("c"), F.col("bc").alias("g"), "blo", "bhi")
    q = nodes.join(asked, "c").where(_gap2("x", "x", "blo", "bhi") <= graph.beyond).select("id", "g", "x")
    donors = nodes.select("id", F.col("c").alias("g"), "x", F.lit(None).cast("double").alias("payload"))
    stars = (_chunked_pairs(q, donors, chunk_rows).groupBy("g", "qc", "dc")
             .applyInPandas(_star_kernel(eps), "id long, root long").distinct())
    of = lambda c, s: nodes.select(F.col("id").alias(c), F.col("node").alias(s))
    found = cut_lineage(stars.join(of("id", "a"), "id").join(of("root", "b"), "root").where("a <> b").select("a", "b").distinct())
    if not found.isEmpty():
        roots = components(found.unionByName(edges), "a", "b")
    out = nodes.join(roots, "node", "left").select("id", "x", "c", F.coalesce("root", "node").alias("label"))
    out = cut_lineage(out)
    for cached in (pairs, nodes):
        cached.unpersist()
    return out


def dbscan(df: DataFrame, features, key: str, eps: float = 1.5, min_samples: int = 10, grid_dims: int = 2,
           chunk_rows: int = 2048, out: str = "cluster", core: DataFrame | None = None) -> DataFrame:
    """Density clustering: label per row (noise = -1). Clusters are numbered 0.. in the order of their smallest
    core key (the scan order of the classic algorithm). Rows whose vector holds a null or NaN are noise.

    ``core``: (id) of the core rows where they are known already, as in ``dbscan_grid_search``. Rows that share one
    place cost linear work; so does a dense region where the grid covers every coordinate. In wider vectors
    the rows of dense cells are measured against each other, in chunks."""
    from ..sources.sinks import with_row_number

    if eps <= 0:
        raise ValueError("eps must be positive")
    p = _prepare(df, features, key).where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)))
    m = grid_dims_of(p, grid_dims)
    if m == 0:
        return df.withColumn(out, F.lit(-1))
    side, ring = eps / math.sqrt(m) * (1 + 1e-9), math.ceil(math.sqrt(m))
    p = with_grid_coords(p, m, grid_basis(p, m)).select("id", "x", _cell(F.col("gx"), side, m).alias("c")).persist()
    graph = CellGraph(p, eps, m, ring)
    cores = cut_lineage(_core(p, graph, eps, min_samples, chunk_rows) if core is None else p.join(core.select("id"), "id").select("id", "x", "c"))
    if cores.isEmpty():
        graph.release()
        p.unpersist()
        return df.withColumn(out, F.lit(-1))
    cgraph = CellGraph(cores, eps, m, ring, outermost=True)
    linked = _linked(cores, cgraph, eps, chunk_rows)
    numbers = with_row_number(linked.select("label").distinct(), ["label"], "no")
    inner = linked.join(numbers, "label").select("id", "x", "c", "no").persist()
    # of a cell no wider than eps all core rows have one label
    cells = cgraph.cells.join(inner.groupBy("c").agg(F.min("no").alias("no")), "c")
    cells = cells.select(F.col("c").alias("g"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"), "tight", "no")
    visits = (p.join(cores.select("id"), "id", "left_anti").join(graph.pairs.select(F.col("ac").alias("c"), F.col("bc").alias("g")), "c")
              .join(cells, "g").where(_gap2("x", "x", "blo", "bhi") <= graph.beyond)
              .withColumn("all", F.col("tight") & (_reach2("x", "x", "blo", "bhi") <= graph.within)))
    donors = inner.select("id", F.col("c").alias("g"), "x", F.col("no").cast("double").alias("payload"))
    measured = (_chunked_pairs(visits.where(~F.col("all")).select("id", "g", "x"), donors, chunk_rows)
                .groupBy("g", "qc", "dc").applyInPandas(_smallest_kernel(eps), "qid long, no long"))
    border = (visits.where("all").select("id", "no").unionByName(measured.select(F.col("qid").alias("id"), "no"))
              .groupBy("id").agg(F.min("no").alias("no")))
    # only (key, cluster) is written: later actions neither measure again nor depend on cached blocks of lost executors
    labels = cut_lineage(inner.select("id", "no").unionByName(border).select(F.col("id").alias("__id"), F.col("no").cast("int").alias("__no")))
    inner.unpersist()
    cgraph.release()
    graph.release()
    p.unpersist()
    res = df.join(labels, qcol(key).cast("long") == F.col("__id"), "left")
    return res.withColumn(out, F.coalesce("__no", F.lit(-1))).drop("__id", "__no")


def relabel_noise(df: DataFrame, label: str = "cluster", noise: int = -1) -> DataFrame:
    """Noise as a cluster of its own: the label after the largest."""
    top = df.agg(F.max(qcol(label))).first()[0]
    if top is None:
        return df
    return df.withColumn(label, F.when(qcol(label) == noise, F.lit(top + 1)).otherwise(qcol(label)).cast(df.schema[label].dataType))


def dbscan_grid_search(df: DataFrame, features, key: str, eps_values: Sequence[float],
                       min_samples_values: Sequence[int], parallelism: int = 3) -> DataFrame:
    """(eps, min_samples, n_clusters, noise_ratio, silhouette) for every combination.

    The distance to a row's ``min_samples``-th neighbour says for every eps whether it is a core row, so one neighbour
    table serves all combinations. The silhouette (noise as a group of its own) is null for fewer than two clusters
    and where every row is a cluster; it is the one on squared distances, linear in the rows. ``parallelism`` combinations run at a time."""
    from .evaluate import noise_stats, silhouette

    most = max(min_samples_values)
    ids = df.select(qcol(key).cast("long").alias("id"))
    table = knn_join(df, df, features, max(1, most - 1), key, key, exclude_self=True).where(F.col("rank").isin([ms - 1 for ms in min_samples_values]))
    table = cut_lineage(table.select(F.col("qid").alias("id"), "rank", "dist"))
    n = df.count()

    def score(pair: tuple[float, int]) -> tuple:
        eps, ms = pair
        core = ids if ms <= 1 else table.where((F.col("rank") == ms - 1) & (F.col("dist") <= F.lit(float(eps)))).select("id")
        lab = dbscan(df, features, key, eps, ms, core=core).persist()
        s = noise_stats(lab, "cluster").first()
        score = silhouette(lab, features, "cluster") if 1 < s["n_clusters"] < n else None
        lab.unpersist()
        return float(eps), int(ms), int(s["n_clusters"]), float(s["noise_ratio"] or 0.0), score

    # the combinations do not depend on each other, and each is many short stages that leave cores idle
    pool = ThreadPool(parallelism)
    try:
        rows = pool.map(inheritable_thread_target(df.sparkSession)(score), [(eps, ms) for eps in eps_values for ms in min_samples_values], chunksize=1)
    finally:
        pool.close()
    return df.sparkSession.createDataFrame(rows, "eps double, min_samples int, n_clusters int, noise_ratio double, silhouette double")
