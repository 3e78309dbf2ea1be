"""Source divergence audit: how far the sources of a language lie apart in their terms.

The term rows of a language (a kept term's nonzero counts, ordered by source) are inserted into a
frequent-pattern tree: rows with a common prefix share its nodes, and a node's multiplicity is the number of
terms below it. With p_s(c) the share of a term that source s has c times and z_s = p_s(0), the distance of two
sources over all V terms is

    V * |z_s - z_t|                                                               all terms, as if both counts were 0
    + sum over nodes of s, m * (|p_s(a) - z_t| - |z_s - z_t|), and t likewise     one of the counts isn't 0
    + sum over a node of t below a node of s,
      m * (|p_s(a) - p_t(b)| - |p_s(a) - z_t| - |z_s - p_t(b)| + |z_s - z_t|)     neither is

so the pairs' corrections are taken once per node and ancestor, not once per term, and terms that both sources
lack cost nothing. Everything is exact in whole numbers.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import written

UNIT = 1_000_000_000
SMOOTH = 5
#: A term is a run of ASCII letters and bytes of other characters; all else separates. A-Z are lowered.
LETTERS = bytes((c + 32 if 65 <= c <= 90 else c) if 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SLICE = 4 << 20


def terms_of(text: str):
    """The terms of a text as UTF-8, in lists that each come from a few MB."""
    data = text.encode().translate(LETTERS)
    lo = 0
    while lo < len(data):
        hi = lo + SLICE
        if hi < len(data):
            hi = (data.find(b" ", hi) + 1) or len(data)
        yield data[lo:hi].split()
        lo = hi


def term_counts(df: DataFrame, text_col: str, lang_col: str, source_col: str, held: int = 200_000) -> DataFrame:
    """(lang, source, term, n, docs): partial counts, summed per task up to ``held`` entries at a time.

    Every (lang, source) also has a row with a null term, so groups without terms are known."""

    def run(batches):
        counts, size = {}, 0

        def rows():
            names = list(counts)
            many = [len(counts[g][0]) + 1 for g in names]
            n, docs, term = [], [], []
            for g in names:
                n += [*counts[g][0].values(), 0]
                docs += [*map(counts[g][1].__getitem__, counts[g][0]), 0]
                term += [*counts[g][0], None]
            term = pa.array(term, pa.binary()).cast(pa.string())
            lang, source = (pa.array(np.repeat(np.array([g[i] for g in names], dtype=object), many), pa.string()) for i in (0, 1))
            return pa.RecordBatch.from_arrays([lang, source, term, pa.array(n, pa.int64()), pa.array(docs, pa.int64())], ["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n, docs = counts.setdefault((lang or "", source or ""), (Counter(), Counter()))
                before, seen = len(n), set()
                for terms in terms_of(text or ""):
                    n.update(terms)
                    seen.update(terms)
                docs.update(seen)
                size += len(n) - before
                if size >= held:
                    yield rows()
                    counts, size = {}, 0
        if counts:
            yield rows()

    some = df.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{source_col}`").cast("string").alias("source"), F.col(f"`{text_col}`").alias("text"))
    return some.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def share(count: Column, whole: Column) -> Column:
    """1 + floor(UNIT * (count + SMOOTH) / whole), exact beyond 64 bits."""
    over = F.lit(UNIT).cast("decimal(10,0)") * (count + SMOOTH).cast("decimal(19,0)")
    return F.call_function("div", over, whole.cast("decimal(19,0)")) + 1


def tree(counts: list[np.ndarray], sources: list[np.ndarray], times: np.ndarray) -> tuple[np.ndarray, ...]:
    """The tree of some term rows: (parent, source, count, multiplicity) of every node, parents before children."""
    at, parent, source, count, many = {}, [], [], [], []
    for s, c, m in zip(sources, counts, times.tolist(), strict=True):
        node = -1
        for item in zip(s.tolist(), c.tolist(), strict=True):
            key = (node, *item)
            node = at.get(key, -1)
            if node < 0:
                node = at[key] = len(parent)
                parent.append(key[0])
                source.append(item[0])
                count.append(item[1])
                many.append(0)
            many[node] += m
    return tuple(np.array(x, dtype=np.int64) for x in (parent, source, count, many))


def corrections(parent: np.ndarray, source: np.ndarray, p: np.ndarray, z: np.ndarray, many: np.ndarray, k: int) -> np.ndarray:
    """k x k sums, one addend for every node (column) and ancestor (row)."""
    out = np.zeros(k * k, dtype=np.int64)
    node, up = np.arange(len(parent)), parent.copy()
    while (on := up >= 0).any():
        node, up = node[on], up[on]
        f = abs(p[up] - p[node]) - abs(p[up] - z[node]) - abs(z[up] - p[node]) + abs(z[up] - z[node])
        np.add.at(out, source[up] * k + source[node], f * many[node])
        up = parent[up]
    return out.reshape(k, k)


def tree_sums(rows: DataFrame) -> DataFrame:
    """(lang, a, b, value): the corrections of sources a < b from (lang, path, m) rows, a path being an ordered
    array of (source, n, p, z). Rows are dealt in order, so that neighbours share their paths, and a tree
    holds the rows of one batch: its size is bounded whatever the number of terms."""

    def run(batches):
        for batch in batches:
            lang, times = batch.column(0).to_numpy(zero_copy_only=False), np.asarray(batch.column(2))
            path = batch.column(1)
            ends = np.asarray(path.offsets)
            items = path.values
            code, name = pd.factorize(items.field(0).to_numpy(zero_copy_only=False), sort=True)
            n, p, z = (np.asarray(items.field(i)) for i in (1, 2, 3))
            for one in pd.unique(lang):
                mine = np.flatnonzero(lang == one)
                cut = [slice(ends[i], ends[i + 1]) for i in mine]
                parent, source, count, many = tree([n[c] for c in cut], [code[c] for c in cut], times[mine])
                # a share follows from source and count, so any item with them has it
                of = {(int(code[j]), int(n[j])): (int(p[j]), int(z[j])) for c in cut for j in range(c.start, c.stop)}
                got = np.array([of[x] for x in zip(source.tolist(), count.tolist(), strict=True)], dtype=np.int64).reshape(-1, 2)
                sums = corrections(parent, source, got[:, 0], got[:, 1], many, len(name))
                a, b = np.nonzero(sums)
                yield pa.RecordBatch.from_arrays([pa.array([one] * len(a), pa.string()), pa.array(name[a], pa.string()), pa.array(name[b], pa.string()), pa.array(sums[a, b])],
                                                 ["lang", "a", "b", "value"])

    ordered = rows.select("lang", "path", "m").repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    return ordered.mapInArrow(run, "lang string, a string, b string, value long")


def audit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = 30, top: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank) for every occurring (lang, source).

    Null texts, languages and sources count as ''. A language keeps the terms found in at least ``least`` of its rows.
    Part ``pair``: every other source of the language with the distance of their shares over all kept terms
    (0 if the language keeps none). Part ``term``: the kept terms that the source has more often than its language,
    the ``top`` of largest excess. Ranks follow falling values, ties by UTF-8. Repeated rows count each; a group
    without terms takes part with counts of 0. An empty table gives no rows. Other columns aren't read, so their
    names can't clash; texts of any length are counted a few MB at a time."""
    parts = term_counts(df, text_col, lang_col, source_col)
    sums = parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # a term's row per language; the row of the null term lists the language's sources
    rows = sums.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("has"))
    rows = written(rows.where(F.col("term").isNull() | (F.col("docs") >= least)).drop("docs"), "terms")
    kept = rows.where("term is not null")
    has = kept.select("lang", "term", "total", F.inline("has"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    groups = rows.where("term is null").select("lang", F.explode("has.source").alias("source"))
    groups = groups.join(has.groupBy("lang", "source").agg(F.sum("n").alias("own")), ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("v", F.lit(0)).alias("v"), (F.coalesce("own", F.lit(0)) + SMOOTH * F.col("v")).alias("whole"), "lang_n")
    groups = written(groups.withColumn("z", F.when(F.col("v") > 0, share(F.lit(0), F.col("whole")))), "groups")
    items = has.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("whole")))
    excess = F.col("p") - share(F.col("total"), F.col("lang_n") + SMOOTH * F.col("v"))
    terms = items.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), excess.alias("value")).where("value > 0")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    paths = items.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "n", "p", "z"))).alias("path")).groupBy("lang", "path").agg(F.count("*").alias("m"))
    both = tree_sums(paths)
    here, there = groups.select("lang", F.col("source").alias("a"), "v", F.col("z").alias("za")), groups.select("lang", F.col("source").alias("b"), F.col("z").alias("zb"))
    base = here.join(there, "lang").where("a != b").select("lang", "a", "b", F.when(F.col("v") > 0, F.col("v") * F.abs(F.col("za") - F.col("zb"))).otherwise(0).alias("value"))
    nodes = items.groupBy("lang", F.col("source").alias("a"), F.col("z").alias("za"), "p").agg(F.count("*").alias("m"))
    single = nodes.join(there, "lang").where("a != b").select("lang", "a", "b", (F.col("m") * (F.abs(F.col("p") - F.col("zb")) - F.abs(F.col("za") - F.col("zb")))).alias("value"))
    mirror = lambda x: x.unionByName(x.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    pairs = base.unionByName(mirror(single)).unionByName(mirror(both)).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(terms)
