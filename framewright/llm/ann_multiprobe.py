"""Approximate nearest neighbours by multiprobe p-stable hashing.

Every table hashes a vector by the slots of several Gaussian (2-stable) projections. A neighbour at
distance r of a query falls into each slot with a known probability, so the perturbed buckets of a
query are visited in descending order of estimated success (the product over projections) until
the visited ones hold a given share. Candidates of all tables are merged and ranked by exact distance.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import written
from .textkit import mix64
from .vectors import decode, sample_of, width_of

REACH = 6  # slots looked at on either side of a query


class Tables:
    """Projections of every table, with slots ``slot`` times as wide as the expected distance ``r``."""

    def __init__(self, width: int, tables: int, hashes: int, r: float, slot: float, seed: int):
        rng = np.random.default_rng(seed)
        self.r, self.slot = r, slot * r
        self.a = rng.normal(size=(tables, width, hashes))
        self.b = rng.uniform(0, self.slot, (tables, hashes))

    def places(self, x: np.ndarray, t: int) -> np.ndarray:
        return (x @ self.a[t] + self.b[t]) / self.slot

    @staticmethod
    def keys(cells: np.ndarray) -> np.ndarray:
        out = np.zeros(len(cells), dtype=np.uint64)
        for j in range(cells.shape[1]):
            out = mix64(out * np.uint64(31) + np.clip(cells[:, j], -(2.0**62), 2.0**62).astype(np.int64).astype(np.uint64) + np.uint64(1))
        return out.view(np.int64)

    def probes(self, place: np.ndarray, share: float) -> np.ndarray:
        """Cells of one query, most promising first, until their estimated success reaches ``share``."""
        low, slots = np.floor(place), []
        for j, at in enumerate(place):
            near = []
            for d in range(-REACH, REACH + 1):
                a = (low[j] + d - at) * self.slot / self.r / math.sqrt(2)
                p = 0.5 * (math.erf(a + self.slot / self.r / math.sqrt(2)) - math.erf(a))
                if p > 1e-6:
                    near.append((p, low[j] + d))
            slots.append(sorted(near, reverse=True))
        first = (0,) * len(slots)
        heap, seen, got, out = [(-math.prod(s[0][0] for s in slots), first)], {first}, 0.0, []
        while heap and got < share:
            p, at = heapq.heappop(heap)
            got -= p
            out.append([s[i][1] for s, i in zip(slots, at, strict=True)])
            for j, s in enumerate(slots):
                nxt = (*at[:j], at[j] + 1, *at[j + 1:])
                if at[j] + 1 < len(s) and nxt not in seen:
                    seen.add(nxt)
                    heapq.heappush(heap, (p / s[at[j]][0] * s[at[j] + 1][0], nxt))
        return np.array(out)


def nearest(q: np.ndarray, qid: np.ndarray, x: np.ndarray, xid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance): each query's ``k`` nearest rows of other ids, by exact double distance."""
    with np.errstate(over="ignore", invalid="ignore"):
        rough = np.maximum((q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1) - 2 * (q @ x.T), 0)
        own, odd = qid[:, None] == xid, ~np.isfinite(rough)  # squares of huge components overflow: those rows are all compared
        rough[own | odd] = np.inf
        out = []
        for i in range(len(q)):
            row = rough[i]
            cut = np.partition(row, k - 1)[k - 1] if len(row) > k else np.inf
            near = np.flatnonzero(((row <= cut * (1 + 1e-9) + 1e-9 * float(q[i] @ q[i])) | odd[i]) & ~own[i])
            diff = x[near] - q[i]
            most = np.abs(diff).max(axis=1, initial=0)
            plain = np.sqrt((diff**2).sum(axis=1))
            scaled = most * np.sqrt(((diff / np.where(most > 0, most, 1)[:, None]) ** 2).sum(axis=1))
            d = np.where(np.isfinite(plain), plain, scaled)
            best = np.lexsort((xid[near], d))[:k]
            out.append((np.full(len(best), qid[i]), xid[near[best]], d[best]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def search(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 100, k: int = 10, tables: int = 4, hashes: int = 6,
           slot: float = 1.8, share: float = 0.5, sample: int = 2000, block: int = 4096, seed: int = 11) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest found of every row whose id is divisible by ``every``.

    A bounded sample gives the expected distance of a k-th neighbour; every row is indexed in every
    table. A bucket is cut into blocks of about ``block`` rows, and its queries likewise, so a
    bucket that holds a third of all rows is many small tasks. A query that found fewer than
    ``k`` rows is compared with all blocks of the first table. Vectors that are null, zero, of another
    than the commonest length or hold null or non-finite components take no part, nor do null ids. Ties go to the smaller
    id; distances whose squares overflow are still compared; rows that repeat an id count once, at their nearest; a query never finds its own id. Tables without two vectors give no rows."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).where(F.col("id").isNotNull())
    width = width_of(rows, "vec")
    x = sample_of(rows, "id", "vec", sample, width) if width else np.zeros((0, 1))
    if len(x) < 2:
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    with np.errstate(over="ignore", invalid="ignore"):
        d = np.sqrt(np.maximum((x * x).sum(axis=1)[:200, None] + (x * x).sum(axis=1) - 2 * (x[:200] @ x.T), 0))
    kth = np.sort(d, axis=1)[:, min(k, len(x) - 1)]  # those not finite come last
    r = float(np.median(kth[np.isfinite(kth)])) if np.isfinite(kth).any() else 1.0
    r = r or 1.0
    lsh = Tables(width, tables, hashes, r, slot, seed)
    keyed = "t int, key long, id long, vec binary"

    def hashed(probing: bool):
        def run(batches):
            for batch in batches:
                ok, x = decode(batch.column("vec"), width)
                ids, x = np.asarray(batch.column("id"))[ok], x[ok]
                raw = pa.array([v.tobytes() for v in x], pa.binary())
                for t in range(tables):
                    place = lsh.places(x, t)
                    cells = [lsh.probes(p, share) for p in place] if probing else [np.floor(place)]
                    at = np.repeat(np.arange(len(x)), [len(c) for c in cells]) if probing else np.arange(len(x))
                    keys = lsh.keys(np.concatenate(cells)) if cells else np.zeros(0, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), t, np.int32)), pa.array(keys), pa.array(ids[at]), raw.take(pa.array(at))],
                                                     ["t", "key", "id", "vec"])
        return run

    index = written(rows.mapInArrow(hashed(False), keyed), "index")
    asking = rows.where(F.col("id") % every == 0)
    probes = written(asking.mapInArrow(hashed(True), keyed), "probes")
    buckets = index.groupBy("t", "key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))

    def ranked(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"query_id": [], "id": [], "score": []})
        if len(left) and len(right):
            q, x = (np.frombuffer(b"".join(f["vec"]), dtype=np.float64).reshape(-1, width) for f in (left, right))
            found = nearest(q, left["id"].to_numpy(), x, right["id"].to_numpy(), k)
            out = pd.DataFrame(dict(zip(("query_id", "id", "score"), found, strict=True)))
        return out.astype({"query_id": "int64", "id": "int64", "score": "float64"})

    def merged(asked: DataFrame) -> DataFrame:
        """Each query's nearest rows over the blocks of the buckets that it asks."""
        grid = asked.groupBy("t", "key").agg(F.ceil(F.count("*") / block).cast("int").alias("parts")).join(buckets, ["t", "key"])
        deal = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)).cast("int")
        spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = asked.join(grid, ["t", "key"]).select("t", "key", "id", "vec", deal("parts", 1).alias("p"), spread("blocks").alias("b"))
        right = index.join(grid, ["t", "key"]).select("t", "key", "id", "vec", deal("blocks", 2).alias("b"), spread("parts").alias("p"))
        left, right = left.toDF(*left.columns), right.toDF(*right.columns)  # columns of their own
        by = ["t", "key", "b", "p"]
        got = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(ranked, "query_id long, id long, score double")
        best = got.groupBy("query_id", "id").agg(F.min("score").alias("score"))
        return best.withColumn("rank", F.expr("row_number() over (partition by query_id order by score, id)")).where(F.col("rank") <= k)

    found = written(merged(probes), "found")
    few = probes.select("id", "vec").distinct().join(found.where(F.col("rank") == k).select(F.col("query_id").alias("id")), "id", "left_anti")
    if not few.isEmpty():
        all_keys = few.withColumn("t", F.lit(0)).join(buckets.select("t", "key"), "t").select("t", "key", "id", "vec")
        rest = merged(all_keys)
        found = found.join(few.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(rest)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
