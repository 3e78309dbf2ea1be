"""Nearest neighbours and embedding near-dedup against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.llm import ann_multiprobe, multi_index
from framewright.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"
BAD = [(9001, None, 1), (9002, [], 1), (9003, [0.0] * 8, 1), (9004, [float("nan")] + [1.0] * 7, 1), (9005, [None] + [1.0] * 7, 1),
       (9006, [float("inf")] + [1.0] * 7, 1), (9007, [1.0] * 3, 1)]


def vectors(n=900, width=8, seed=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, width))
    x[n // 3:2 * n // 3] = x[0] + 0.02 * r.normal(size=(2 * n // 3 - n // 3, width))  # one large group of near copies
    x[-20:] = x[1]  # exact copies
    return x.astype(np.float32)


def frame(spark, x, extra=()):
    rows = [(i, [float(c) for c in v], i % 3 if i % 50 else None) for i, v in enumerate(x)]
    return spark.createDataFrame([*rows, *extra], SCHEMA).withColumn("key", F.lit("clash")).withColumn("node", F.lit(1)).repartition(4)


def test_search_recall_order_and_scores(spark):
    x = vectors().astype(np.float64)
    got = ann_multiprobe.search(frame(spark, x, BAD)).collect()
    hit = 0
    for q in range(0, len(x), 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        best = np.lexsort((np.arange(len(x)), d))[:10]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert [(m[2], m[1]) for m in mine] == sorted((m[2], m[1]) for m in mine)
        assert all(abs(m[2] - d[m[1]]) < 1e-12 for m in mine)
        hit += len({m[1] for m in mine} & set(best.tolist()))
    assert hit >= 0.9 * 10 * 9 and {r.query_id for r in got} == set(range(0, 900, 100))


def test_search_ties_go_to_smaller_ids_and_small_tables_give_all(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0], 0) for i in (0, 3, 1, 2, 1, 100)] + [(None, [1.0, 2.0], 0)], SCHEMA)
    got = sorted((r.query_id, r.rank, r.vec_id) for r in ann_multiprobe.search(df).collect())
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 3), (0, 4, 100), (100, 1, 0), (100, 2, 1), (100, 3, 2), (100, 4, 3)]
    assert ann_multiprobe.search(df.limit(0)).count() == 0
    assert ann_multiprobe.search(spark.createDataFrame(BAD, SCHEMA)).count() == 0


def test_op2_recall_on_the_given_table(spark):
    got = QUERIES["op2_ann_multiprobe"](spark, "/root/testdata/sf0.01").collect()
    t = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id").collect()
    x, ids = np.array([r.embedding for r in t]), np.array([r.vec_id for r in t])
    hit = total = 0
    for q in ids[ids % 100 == 0]:
        d = ((x - x[ids == q]) ** 2).sum(axis=1)
        d[ids == q] = np.inf
        hit += len(set(ids[np.argsort(d)[:10]]) & {r.vec_id for r in got if r.query_id == q})
        total += 10
    assert hit >= 0.9 * total


@pytest.mark.parametrize("block", [1024, 16])
def test_links_match_brute_force(spark, block):
    x = vectors().astype(np.float64)
    df = frame(spark, x, BAD)
    got = {r.vec_id: r for r in multi_index.link(df, block=block).collect()}
    label = np.array([i % 3 if i % 50 else -1 for i in range(len(x))])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.98) & (label[:, None] == label) & (label >= 0)[:, None]
    np.fill_diagonal(near, False)
    root = np.arange(len(x))
    while True:
        new = np.minimum(root, np.where(near, root, len(x)).min(axis=1))
        if (new == root).all():
            break
        root = new
    assert len(got) == len(x) + len(BAD)
    assert [got[i].n_links for i in range(len(x))] == near.sum(axis=1).tolist()
    assert [got[i].component_id for i in range(len(x))] == root.tolist()
    assert all(got[b[0]].n_links == 0 and got[b[0]].component_id == b[0] and got[b[0]].kept for b in BAD)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_links_of_empty_and_vectorless_tables(spark):
    df = spark.createDataFrame(BAD, SCHEMA)
    assert multi_index.link(df.limit(0)).count() == 0
    assert [r.n_links for r in multi_index.link(df.where("vec_id < 9004")).collect()] == [0, 0, 0]


def test_links_of_every_length_and_without_ids(spark):
    rows = [(1, [1.0, 2.0], "a"), (2, [2.0, 4.0], "a"), (3, [1.0, 0.0, 0.0], "a"), (4, [3.0, 0.0, 0.0], "a"), (5, [0.0, 1.0, 0.0], "a"),
            (7, [5.0, 5.0, 5.0], "b"), (8, [5.0, 5.0, 5.0], "b"), (None, [5.0, 5.0, 5.0], "b"), (None, [9.0, 0.0, -9.0], "b"), (None, [9.0, 0.0, -9.0], "b"), (9, None, "a"), (10, [], "a")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = sorted(((r.vec_id or 0), r.n_links, r.component_id or 0) for r in multi_index.link(df).collect())
    assert got == [(0, 1, 0), (0, 1, 0), (0, 2, 7), (1, 1, 1), (2, 1, 1), (3, 1, 3), (4, 1, 3), (5, 0, 5), (7, 2, 7), (8, 2, 7), (9, 0, 9), (10, 0, 10)]


def test_search_of_huge_components(spark):
    rows = [(i, [1e200 * (i + 1), -1e200, float(i)]) for i in range(0, 700, 50)] + [(i, [float(i), 1.0, 2.0]) for i in range(1, 40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann_multiprobe.search(df, k=3).collect()
    assert len(got) == 7 * 3
    of = dict(rows)
    for r in got:  # the scale of a component doesn't spoil the distance
        d = [x - y for x, y in zip(of[r.query_id], of[r.vec_id], strict=True)]
        assert r.vec_id != r.query_id and abs(r.score / math.hypot(*d) - 1) < 1e-12
