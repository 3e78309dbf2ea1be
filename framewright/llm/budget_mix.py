"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a target in words. A source's whole epochs are taken first; what remains of its
target is fitted exactly from its length histogram: documents are counted by exact length, each
length gives its proportional share, and a bounded-knapsack dynamic programme over the counts left
fills the remaining budget. Which documents of a length are taken is decided by a seeded hash.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import counted, written

WEIGHTS = (5.0, 2.0, 1.0)


def targets(sizes: list[int], weights: list[float], share: float = 1.5, cap: float = 2.0) -> list[float]:
    """Share ``share`` x all sizes by weight; no target exceeds ``cap`` x its size, and what is
    above is shared among the rest by weight until none is above."""
    out, left, rest = [0.0] * len(sizes), share * sum(sizes), list(range(len(sizes)))
    while rest:
        whole = sum(weights[i] for i in rest)
        over = [i for i in rest if left * weights[i] / whole > cap * sizes[i]]
        for i in over or rest:
            out[i] = float(cap * sizes[i]) if over else left * weights[i] / whole
        if not over:
            break
        rest = [i for i in rest if i not in set(over)]
        left -= sum(out[i] for i in over)
    return out


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int, window: int = 1 << 16) -> np.ndarray:
    """How many documents of each length make up ``budget`` words, or come nearest to it.

    Proportional shares first, then the longest lengths until at most ``window`` words are left
    open, then a bounded-knapsack programme (counts split into powers of two) over those words. The
    programme looks as far above the budget as taking nothing more would be below it."""
    whole = int((lengths * counts).sum())
    if budget >= whole:
        return counts.copy()
    take = counts * budget // whole if whole < 2**31 else np.array([int(c) * budget // whole for c in counts])
    left, budget = counts - take, budget - int((lengths * take).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if budget <= window:
            break
        if lengths[i]:
            n = min(int(left[i]), (budget - window // 2) // int(lengths[i]))
            if n > 0:
                take[i], left[i], budget = take[i] + n, left[i] - n, budget - n * int(lengths[i])
    top = budget + min(budget, int(lengths[left > 0].max(initial=0)))
    by = np.full(top + 1, -1, dtype=np.int64)  # the item that first reached each sum
    can = np.zeros(top + 1, dtype=bool)
    can[0], items = True, []
    for i in np.argsort(lengths, kind="stable"):
        size, n, part = int(lengths[i]), int(left[i]), 1
        while n > 0 and 0 < size <= top and not can[budget]:
            k = min(part, n)
            n, part = n - k, part * 2
            if (step := k * size) > top:
                break
            new = np.zeros_like(can)
            new[step:] = can[:-step] & ~can[step:]
            by[new], can = len(items), can | new
            items.append((i, k, step))
    sums = np.flatnonzero(can)
    at = int(sums[np.argmin(np.abs(sums - budget))])
    while at:
        i, k, step = items[by[at]]
        take[i] += k
        at -= step
    return take


def mix(df: DataFrame, key_col: str, source_col: str, text_col: str, share: float = 1.5, weights: tuple = WEIGHTS,
        cap: float = 2.0, seed: int = 7, lanes: int = 256, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: key and source) of every row, and size, source_size, target, times, taken.

    Sources are ordered by code point, null last, and weigh ``weights`` in turn. One row per source
    comes to the driver; one task holds one source's histogram of lengths, never its documents.
    The rank of a document among those of its source and length is counted in ``lanes`` hash
    lanes, so a length that a third of all rows share is still ranked by many tasks. Null and
    empty texts have size 0 and add nothing; they are taken with whole epochs only. Equal rows are
    interchangeable. An empty table gives no rows. Kept columns travel in one struct; those
    with the name of a result column give way to it."""
    spark = df.sparkSession
    keep = keep or list(dict.fromkeys([key_col, source_col]))
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("")).alias("s"),
        F.xxhash64(F.col(key_col), F.lit(seed)).alias("h"), F.col(text_col).alias("t"))
    rows = counted(rows, "t", "size").withColumn("lane", F.shiftrightunsigned("h", 48).cast("int") % lanes)
    rows = written(rows, "sizes")
    hist = rows.select("s", "size").groupBy("s", "size").count()
    sums = sorted(tuple(r) for r in hist.groupBy("s").agg(F.sum(F.col("size") * F.col("count"))).collect())  # a row per source
    sums = [x for x in sums if x[0]] + [x for x in sums if not x[0]]
    goal = targets([x[1] for x in sums], [weights[i % len(weights)] for i in range(len(sums))], share, cap)
    goals = spark.createDataFrame([(s, int(n), float(t), min(int(t // n), math.floor(cap)) if n else 0)
                                   for (s, n), t in zip(sums, goal, strict=True)], "s string, source_size long, target double, epochs int")

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        rest = int(pdf["target"].iloc[0]) - int(pdf["epochs"].iloc[0]) * int(pdf["source_size"].iloc[0])
        pdf = pdf.sort_values("size")
        more = fit(pdf["size"].to_numpy(), pdf["count"].to_numpy(), rest) if rest > 0 else np.zeros(len(pdf), dtype=np.int64)
        return pdf[["s", "size", "source_size", "target", "epochs"]].assign(more=more)

    plan = hist.join(F.broadcast(goals), "s").groupBy("s").applyInPandas(
        fitted, "s string, size long, source_size long, target double, epochs int, more long")
    lane = rows.groupBy("s", "size", "lane").count().withColumn(
        "before", F.expr("sum(count) over (partition by s, size order by lane) - count")).drop("count")
    plan = plan.join(lane, ["s", "size"])
    rank = F.expr("row_number() over (partition by s, size, lane order by h, row)")
    times = F.col("epochs") + F.when(F.col("before") + F.col("rank") <= F.col("more"), 1).otherwise(0)
    return (rows.withColumn("rank", rank).join(plan, ["s", "size", "lane"])
            .select(*[F.col(f"row.`{c}`").alias(c) for c in keep if c not in ("size", "source_size", "target", "times", "taken")], "size", "source_size", "target", times.cast("int").alias("times"),
                    (times * F.col("size")).cast("long").alias("taken")))
