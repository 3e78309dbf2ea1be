"""Small DataFrame helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .textkit import word_counts


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, rows_a_file: int = 0) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared checkpoint folder and read it back.

    The folder is the one that ``spark.checkpoint.dir`` names, so a lost executor loses nothing. The
    shuffle files of the write are removed when it ends; nothing reads them afterwards. Long rows can be dealt out to
    files of ``rows_a_file``, as Parquet's reader holds up to 4,096 rows of a file at once."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").option("maxRecordsPerFile", rows_a_file).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def chunks_of(batch: pa.RecordBatch, text: int, size: int = 1 << 20):
    """Slices of ``batch`` with about ``size`` bytes in column ``text``; a longer text is a slice of its own."""
    lengths = np.asarray(pc.binary_length(batch.column(text)).fill_null(0), dtype=np.int64)
    ends, lo = np.cumsum(lengths), 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - lengths[lo] + size, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with its text column replaced by the number of words ``out`` (0 for null)."""
    schema = T.StructType([f for f in df.schema if f.name != text] + [T.StructField(out, T.LongType())])
    rest = [f.name for f in df.schema if f.name != text]

    def count(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + [pa.array(word_counts(batch.column(text)))], [*rest, out])

    return df.mapInArrow(count, schema)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): every node of ``edges`` with the smallest node that it reaches.

    Alternating large-star and small-star rounds until every edge points at a root. Each
    round is written to the shared folder. A round only takes minima per node (combined before
    the shuffle) and joins them back, so a hub with many neighbours is a skewed join that
    adaptive execution can split; no component meets in one task or on the driver."""
    u, v = F.col("u"), F.col("v")
    cur = written(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")

    def mark(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    seen = mark(cur)
    while seen[0]:
        both = cur.unionByName(cur.select(v.alias("u"), u.alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.where("true").join(low, "u").where(v > u).select(v.alias("u"), F.col("low").alias("v")).distinct()
        floor = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (large.join(floor, "u").where(v != F.col("low")).select(v.alias("u"), F.col("low").alias("v"))
                 .unionByName(floor.select("u", F.col("low").alias("v"))).distinct())
        cur = written(small, "edges")
        now = mark(cur)
        if now == seen:
            break
        seen = now
    return cur.select(u.alias("node"), v.alias("root")).unionByName(cur.select(v.alias("node"), v.alias("root"))).distinct()


def with_components(rows: DataFrame, key: str, edges: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """``rows`` with ``out``: the component of ``key`` under ``edges``, its own key where it has no edge."""
    roots = components(edges, a, b).select(F.col("node").alias(key), F.col("root").alias(out))
    return rows.join(roots, key, "left").withColumn(out, F.coalesce(F.col(out), F.col(key)))
