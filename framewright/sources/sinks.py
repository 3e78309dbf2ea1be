"""Sinks: CSV / TSV directories and per-column sparse one-hot parquet."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql import functions as F

from ..functions.stats import qcol, string_columns
from ..session import cut_lineage


def sink_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """Header CSV, no index; a directory of part files written in parallel. Quotes in cells are
    doubled, blanks around a cell are kept."""
    (df.write.mode(mode).option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def with_row_number(df: DataFrame, order_by: Sequence[str], name: str = "index",
                    partitions: int | None = None) -> DataFrame:
    """Dense 0-based row number in key order without a single-partition window.

    Rows are range-partitioned and sorted by the key, per-partition row counts (one row
    per partition) give each partition its offset, and a vectorised ``mapInPandas`` adds
    offset + position to every Arrow batch — no Python per row, no global window."""
    spark = df.sparkSession
    parts = partitions or max(spark.sparkContext.defaultParallelism,
                              int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [qcol(c) for c in order_by]
    # checkpointed, not cached: partition ids stay stable even if executors are lost,
    # and nothing stays cached in the session
    ranged = cut_lineage(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
                         .withColumn("__pid", F.spark_partition_id()))
    sizes = {r["__pid"]: r["n"] for r in ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, running = {}, 0
    for pid in sorted(sizes):
        offsets[pid] = running
        running += sizes[pid]
    schema = T.StructType([T.StructField(name, T.LongType(), False)] + list(df.schema.fields))
    cols = df.columns

    def number(batches):
        seen: dict[int, int] = {}
        for pdf in batches:
            if pdf.empty:
                continue
            pid = int(pdf["__pid"].iloc[0])
            start = offsets[pid] + seen.get(pid, 0)
            seen[pid] = seen.get(pid, 0) + len(pdf)
            out = pdf[cols].copy()
            out.insert(0, name, np.arange(start, start + len(pdf), dtype="int64"))
            yield out

    return ranged.mapInPandas(number, schema)


def sink_tsv_with_index(df: DataFrame, path: str, order_by: Sequence[str], mode: str = "overwrite") -> None:
    """Re-number rows by a key and write TSV with the row number as first column."""
    sink_csv(with_row_number(df, order_by), path, sep="\t", mode=mode)


def sink_sparse_onehot(df: DataFrame, out_dir: str, cols: Sequence[str] | None = None, min_freq: float = 0.01,
                       mode: str = "overwrite", key: str | None = None) -> dict[str, str]:
    """One parquet artefact per categorical column holding its sparse one-hot vector,
    next to ``key`` when given (rows have no position to align on in a distributed table).

    Rare categories (share < min_freq) are merged first, which bounds the vector width
    by 1/min_freq + 1."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    from ..operators.encode import merge_rare

    cols = [c for c in (list(cols) if cols is not None else string_columns(df)) if c != key]
    merged = merge_rare(df, cols, threshold=min_freq)
    keep = [qcol(key)] if key else []
    written = {}
    for c in cols:
        idx = StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep", stringOrderType="alphabetAsc")
        enc = OneHotEncoder(inputCol=f"{c}__idx", outputCol=f"{c}__onehot", dropLast=False)
        fitted = idx.fit(merged)
        indexed = fitted.transform(merged)
        out = enc.fit(indexed).transform(indexed).select(*keep, f"{c}__onehot")
        target = f"{out_dir.rstrip('/')}/{c}"
        out.write.mode(mode).parquet(target)
        written[c] = target
    return written

