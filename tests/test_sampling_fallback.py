"""Stratified sampling equals its definition (the round(f * n) smallest md5(seed:key) per
stratum) on the sketch path and on the fallback path a missed sketch takes."""

import hashlib

import pytest
from pyspark.sql import functions as F

from framewright.operators import relational as R


def _expected(n_rows, strata, fraction, seed=42):
    rows = {}
    for k in range(n_rows):
        u = int(hashlib.md5(f"{seed}:{k}".encode()).hexdigest()[:8], 16) / 4294967296.0
        rows.setdefault(k % strata, []).append((u, k))
    out = set()
    for s, items in rows.items():
        m = int((len(items) * fraction) + 0.5)
        out |= {k for _, k in sorted(items)[:m]}
    return out


@pytest.mark.parametrize("accuracy", [10_000, 1])
def test_stratified_sample_matches_definition(spark, accuracy):
    df = spark.range(0, 3000).select(F.col("id").alias("k"), (F.col("id") % 4).alias("s"))
    got = {r.k for r in R.sample_stratified(df, "s", 0.15, "k", accuracy=accuracy).collect()}
    assert got == _expected(3000, 4, 0.15)
