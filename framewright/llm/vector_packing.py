"""Sharding by vector bin packing.

A document's size vector is (bytes, tokens, rows). Documents with equal texts form a group. Groups
are packed into shards one after the other, heaviest first; each goes to the shard where the dot
product of its vector with the shard's residual capacity is highest.

The packing itself must be sequential, so the number of items it sees is bounded, whatever the
corpus: a group that holds at least 1/``bundles`` of any dimension is an item of its own (at most
3 x ``bundles`` of those exist); all other groups are dealt by the hash of their text into
``bundles`` bundles. A group that holds more than half a shard can't be kept together under the
law ``bytes``: it is cut into pieces by the hash of the document id.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import counted, written

DIMS = ("bytes", "tokens", "rows")


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every row of ``vectors`` (items x dimensions), packed heaviest first."""
    total = vectors.sum(axis=0)
    share = vectors / np.where(total > 0, total, 1)
    left = np.full((shards, vectors.shape[1]), 1.0 / shards)
    out = np.zeros(len(vectors), dtype=np.int64)
    for i in np.lexsort((np.arange(len(share)), -share.max(axis=1, initial=0))):
        out[i] = int(np.argmax(left @ share[i]))
        left[out[i]] -= share[i]
    return out


def shard(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8, bundles: int = 4096,
          lanes: int = 64) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard), one row per row of ``df``.

    ``size`` is the text's UTF-8 bytes plus 1; a null text has no bytes and null ``text_crc32``,
    and all null texts are one group. Slots number each shard's rows from 0 by (lane, id), where
    ``lanes`` splits a shard by hash for numbering, so that no task sorts a whole shard; repeated
    rows take neighbouring slots. An empty table gives no rows. Null ids are kept. Input columns
    other than the two named are not read, so their names can't clash."""
    spark = df.sparkSession
    text = F.col("t")
    sized = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).select(
        "id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("bytes"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"), F.coalesce(F.md5(F.encode(text, "UTF-8")), F.lit("")).alias("g"), "t")
    slim = written(counted(sized, "t", "tokens"), "sizes")
    total = slim.agg(F.sum("bytes"), F.sum("tokens"), F.count("*")).first()
    groups = slim.groupBy("g").agg(F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    heavy = F.greatest(*[F.col(d) / F.lit(float(max(t or 0, 1))) for d, t in zip(DIMS, total, strict=True)])
    groups = groups.select("g", *DIMS, heavy.alias("share"))
    bundle = F.concat(F.lit("b"), F.pmod(F.xxhash64("g"), F.lit(bundles)).cast("string"))
    # at most len(DIMS) * bundles rows can pass this filter
    large = groups.where(F.col("share") >= 1.0 / bundles).select(
        "g", F.when(F.col("share") > 0.5 / shards, F.ceil(F.col("share") * bundles)).otherwise(1).cast("int").alias("pieces"))
    piece = F.pmod(F.xxhash64("id", F.lit(1)), F.col("pieces"))
    item = F.when(F.col("pieces").isNull(), bundle).otherwise(F.concat_ws("/", F.lit("g"), "g", piece.cast("string")))
    rows = slim.join(F.broadcast(large), "g", "left").select("id", "bytes", "tokens", "crc", item.alias("item"))
    items = sorted(rows.groupBy("item").agg(F.sum("bytes"), F.sum("tokens"), F.count("*")).collect())
    where = place(np.array([r[1:] for r in items], dtype=float).reshape(-1, len(DIMS)), shards)
    plan = spark.createDataFrame([(r[0], int(s)) for r, s in zip(items, where, strict=True)], "item string, shard int")
    dealt = rows.join(F.broadcast(plan), "item").withColumn("lane", F.pmod(F.xxhash64("id", "crc"), F.lit(lanes)).cast("int"))
    counts = dealt.groupBy("shard", "lane").count().collect()  # shards x lanes rows at most
    first, start = [], {}
    for s, lane, n in sorted(tuple(r) for r in counts):
        first.append((s, lane, start.get(s, 0)))
        start[s] = start.get(s, 0) + n
    first = spark.createDataFrame(first, "shard int, lane int, first long")
    row = F.expr("row_number() over (partition by shard, lane order by id, crc, bytes)")
    return (dealt.withColumn("row", row).join(F.broadcast(first), ["shard", "lane"])
            .select(F.col("id").alias(id_col), F.col("bytes").alias("size"), F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                    "shard", (F.col("first") + F.col("row") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
