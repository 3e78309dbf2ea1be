"""Readers with one missing-value rule: missing = SQL NULL.

Float NaN becomes NULL at ingest (Spark sorts NaN above every number and treats it as
equal to itself, which would break range predicates). Text files use pandas' default
null tokens and a whole-column type inference done as one aggregate job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import qcol

# The null tokens pandas' read_csv recognises by default.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


# Spark's casts also take the suffixes of Java literals (12d, 5f), which are no numbers in a file.
INTEGER = r"^[+-]?[0-9]+$"
DECIMAL = r"^[+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?$|^[+-]?(?i:inf|infinity)$"


def nan_to_null(df: DataFrame) -> DataFrame:
    """Float / double NaN -> NULL, other columns untouched (one projection)."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(F.nanvl(qcol(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            exprs.append(qcol(f.name))
    return df.select(*exprs)


def null_tokens_to_null(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """String cells equal to a null token become NULL (blanks around a token make it text)."""
    toks = F.array(*[F.lit(t) for t in tokens])
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            c = qcol(f.name)
            exprs.append(F.when(~F.array_contains(toks, c), c).alias(f.name))
        else:
            exprs.append(qcol(f.name))
    return df.select(*exprs)


def infer_types(df: DataFrame) -> DataFrame:
    """Whole-column inference for string columns: bigint if every non-null cell is an
    integer, double if every cell is written as a decimal number, else string. One aggregate job."""
    strs = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not strs:
        return df
    exprs = []
    for i, c in enumerate(strs):
        v = F.trim(qcol(c))
        exprs.append(F.count_if(v.isNotNull() & ~(v.rlike(DECIMAL) & v.try_cast("double").isNotNull())).alias(f"d{i}"))
        exprs.append(F.count_if(v.isNotNull() & ~(v.rlike(INTEGER) & v.try_cast("bigint").isNotNull())).alias(f"l{i}"))
        exprs.append(F.count(v).alias(f"n{i}"))
    row = df.agg(*exprs).first()
    target = {}
    for i, c in enumerate(strs):
        if row[f"n{i}"] == 0:
            continue
        if row[f"l{i}"] == 0:
            target[c] = "bigint"
        elif row[f"d{i}"] == 0:
            target[c] = "double"
    return df.select(*[F.trim(qcol(f.name)).try_cast(target[f.name]).alias(f.name) if f.name in target
                       else qcol(f.name) for f in df.schema.fields])


def scan_csv(spark: SparkSession, path: str, sep: str = ",", schema: T.StructType | str | None = None,
             infer: bool = True, limit: int | None = None, multiline: bool = True) -> DataFrame:
    """Header CSV with quoted cells, doubled quotes and line breaks inside quotes. Spark can't split a file
    whose cells may hold line breaks: with ``multiline=False``, for files known to have none, large files
    are read by many tasks. With a schema, parsing is pruned to the projected columns; without, all
    columns load as text, null tokens are normalised and types inferred over the whole column."""
    reader = spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"').option("multiLine", multiline)
    if schema is not None:
        df = reader.schema(schema).csv(path)
        df = nan_to_null(null_tokens_to_null(df))
    else:
        df = null_tokens_to_null(reader.csv(path))
        if infer:
            df = infer_types(df)
    return row_limit(df, limit) if limit is not None else df


def scan_tsv(spark: SparkSession, path: str, **kw) -> DataFrame:
    return scan_csv(spark, path, sep="\t", **kw)


def scan_tsv_gz_limit(spark: SparkSession, path: str, n: int, partitions: int | None = None) -> DataFrame:
    """First ``n`` rows of a gzip TSV. Gzip is not splittable, so the limited frame is
    redistributed before downstream work."""
    df = infer_types(scan_csv(spark, path, sep="\t", infer=False).limit(n).persist())
    return df.repartition(partitions or spark.sparkContext.defaultParallelism)


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                 where: dict[str, tuple] | None = None) -> DataFrame:
    """Columnar read with column pruning and NaN -> NULL.

    ``where`` maps columns to (low, high) bounds (None = open). The bounds are applied to
    the raw columns *before* the NaN rewrite, so Parquet receives them as pushed filters;
    ``NOT isnan`` is added for float columns so the result equals filtering after the
    rewrite (in Spark NaN compares above every number)."""
    df = spark.read.parquet(path)
    if where:
        types = {f.name: f.dataType for f in df.schema.fields}
        cond = F.lit(True)
        for c, (lo, hi) in where.items():
            x = qcol(c)
            if lo is not None:
                cond = cond & (x >= F.lit(lo))
            if hi is not None:
                cond = cond & (x <= F.lit(hi))
            if isinstance(types[c], (T.DoubleType, T.FloatType)):
                cond = cond & ~F.isnan(x)
        df = df.where(cond)
    if columns is not None:
        df = df.select(*[qcol(c) for c in columns])
    return nan_to_null(df)


def row_limit(df: DataFrame, limit: int | None, order_by: Sequence[str] | None = None) -> DataFrame:
    """At most ``limit`` rows; repeatable when ``order_by`` names a key (TakeOrdered)."""
    if limit is None:
        return df
    if order_by:
        df = df.orderBy(*[qcol(c) for c in order_by])
    return df.limit(limit)
