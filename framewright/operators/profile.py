"""Column typing and profiling (inventory 2.2).

Every report is one fused aggregate over all requested columns followed by an
``unpivot`` to long form, so a wide table costs one scan, not one per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import (adjusted_kurtosis, adjusted_skew, as_double, dagostino_k2, datetime_columns,
                               numeric_columns, qcol, quantiles, string_columns)

__all__ = [
    "numeric_columns", "categorical_columns", "datetime_columns", "classify_columns", "column_classes",
    "filter_by_category_count", "table_summary", "null_counts", "duplicate_row_count", "nested_type_columns",
    "negative_values", "error_report", "describe_column", "schema_info", "numeric_profile", "normality_test",
    "skew_kurtosis_table", "categorical_profile", "histogram_bins", "boxplot_stats", "countplot_data",
    "distribution_compare", "filling_percentage", "filling_band",
]


def categorical_columns(df: DataFrame) -> list[str]:
    return string_columns(df)


def _long(df_one_row: DataFrame, cols: Sequence[str], value_name: str) -> DataFrame:
    """One-row wide aggregate -> (column_name, value) rows."""
    return df_one_row.unpivot([], list(cols), "column_name", value_name)


def _distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    fn = (lambda c: F.approx_count_distinct(qcol(c))) if approx else (lambda c: F.count_distinct(qcol(c)))
    return _long(df.agg(*[fn(c).alias(c) for c in cols]), cols, "n_distinct")


def classify_columns(df: DataFrame, threshold: int = 10, approx: bool = False) -> DataFrame:
    """(column_name, kind, n_distinct): numeric, ordinal (string, distinct <= threshold) or nominal.

    ``approx=True`` uses HyperLogLog sketches (no Expand of the input per column)."""
    strs = string_columns(df)
    nums = numeric_columns(df)
    spark = df.sparkSession
    parts = []
    if strs:
        d = _distinct_counts(df, strs, approx)
        parts.append(d.select("column_name", F.when(F.col("n_distinct") <= threshold, "ordinal")
                              .otherwise("nominal").alias("kind"), "n_distinct"))
    if nums:
        parts.append(spark.createDataFrame([(c, "numeric", None) for c in nums],
                                           "column_name string, kind string, n_distinct bigint"))
    if not parts:
        return spark.createDataFrame([], "column_name string, kind string, n_distinct bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def column_classes(df: DataFrame, threshold: int = 10) -> dict[str, list[str]]:
    """Driver-side lists {numeric, ordinal, nominal}: the schema of later steps depends on them."""
    rows = classify_columns(df, threshold).collect()
    out = {"numeric": [], "ordinal": [], "nominal": []}
    order = {c: i for i, c in enumerate(df.columns)}
    for r in sorted(rows, key=lambda r: order[r.column_name]):
        out[r.kind].append(r.column_name)
    return out


def filter_by_category_count(df: DataFrame, min_categories: int = 5, threshold: int = 10) -> DataFrame:
    """Keep numeric columns and the categorical columns with at least ``min_categories`` values."""
    rows = {r.column_name: r for r in classify_columns(df, threshold).collect()}
    keep = [c for c in df.columns if c in rows and
            (rows[c].kind == "numeric" or rows[c].n_distinct >= min_categories)]
    numeric = [c for c in keep if rows[c].kind == "numeric"]
    return df.select(*[qcol(c) for c in numeric + [c for c in keep if c not in numeric]])


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Rows equal to an earlier row, nulls equal (pandas ``duplicated().sum()``).

    Group-by on all columns with map-side partial counts: a hot duplicate group is
    combined before the shuffle."""
    g = df.groupBy(*[qcol(c) for c in df.columns]).count()
    return g.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"))


def table_summary(df: DataFrame) -> DataFrame:
    """n_rows, n_columns, n_null_cells, n_duplicates in one row."""
    nulls = sum((F.count_if(qcol(c).isNull()) for c in df.columns), F.lit(0)) if df.columns else F.lit(0)
    base = df.agg(F.count(F.lit(1)).alias("n_rows"), nulls.cast("bigint").alias("n_null_cells"))
    dup = duplicate_row_count(df).first()[0]
    return base.select("n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
                       "n_null_cells", F.lit(dup).cast("bigint").alias("n_duplicates"))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None, only_positive: bool = True) -> DataFrame:
    """(column_name, n_null) per column; by default only columns holding a null."""
    cols = list(cols) if cols is not None else df.columns
    out = _long(df.agg(*[F.count_if(qcol(c).isNull()).alias(c) for c in cols]), cols, "n_null")
    return out.where(F.col("n_null") > 0) if only_positive else out


def nested_type_columns(df: DataFrame) -> list[str]:
    kinds = (T.ArrayType, T.MapType, T.StructType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def negative_values(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, n_negative) for numeric columns with at least one value < 0."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    out = _long(df.agg(*[F.count_if(qcol(c) < 0).alias(c) for c in cols]), cols, "n_negative")
    return out.where(F.col("n_negative") > 0)


def error_report(df: DataFrame, cols: Sequence[str] | None = None, k: float = 1.5) -> DataFrame:
    """Long form (error_type, column_name, n): missing values, duplicate rows, nested
    types, IQR outlier rows and negative values."""
    from ..functions.stats import tukey_fences

    spark = df.sparkSession
    nums = list(cols) if cols is not None else numeric_columns(df)
    missing = null_counts(df).select(F.lit("missing_values").alias("error_type"), "column_name",
                                     F.col("n_null").alias("n"))
    dups = duplicate_row_count(df).where(F.col("n_duplicates") > 0).select(
        F.lit("duplicate_rows").alias("error_type"), F.lit(None).cast("string").alias("column_name"),
        F.col("n_duplicates").alias("n"))
    nested = spark.createDataFrame([("invalid_data_types", c, None) for c in nested_type_columns(df)],
                                   "error_type string, column_name string, n bigint")
    # outlier rows per column: one conditional count per column over the fitted fences
    fences = tukey_fences(df, nums, k)
    live = [c for c in nums if fences[c][2] is not None]
    if live:
        counts = df.agg(*[F.count_if((as_double(c) < fences[c][2]) | (as_double(c) > fences[c][3])).alias(c)
                          for c in live])
        outl = (_long(counts, live, "n").where(F.col("n") > 0)
                .select(F.lit("outliers").alias("error_type"), "column_name", "n"))
    else:
        outl = spark.createDataFrame([], "error_type string, column_name string, n bigint")
    neg = negative_values(df, nums).select(F.lit("inconsistent_values").alias("error_type"), "column_name",
                                           F.col("n_negative").alias("n"))
    return missing.unionByName(dups).unionByName(nested).unionByName(outl).unionByName(neg)


def describe_column(df: DataFrame, col: str, relative_error: float | None = None) -> DataFrame:
    """count, mean, std (n-1), min, exact quartiles, max, null count: one row."""
    q = quantiles(df, [col], [0.25, 0.5, 0.75], relative_error)[col]
    x = as_double(col)
    return df.agg(
        F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"), F.lit(q[0]).cast("double").alias("q25"), F.lit(q[1]).cast("double").alias("q50"),
        F.lit(q[2]).cast("double").alias("q75"), F.max(x).alias("max"),
        F.count_if(qcol(col).isNull()).alias("n_null"))


def schema_info(df: DataFrame) -> DataFrame:
    """(column_name, dtype, non_null) per column, from the schema plus one count agg."""
    counts = _long(df.agg(*[F.count(qcol(c)).alias(c) for c in df.columns]), df.columns, "non_null")
    types = df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields],
                                           "column_name string, dtype string")
    return F.broadcast(types).join(counts, "column_name")


def numeric_profile(df: DataFrame, cols: Sequence[str] | None = None, relative_error: float | None = None) -> DataFrame:
    """(column_name, n, mean, median, std, skewness g1, kurtosis g2) per numeric column, nulls dropped."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    med = quantiles(df, cols, [0.5], relative_error)
    exprs = []
    for c in cols:
        x = as_double(c)
        exprs.append(F.struct(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                              F.skewness(x).alias("skewness"), F.kurtosis(x).alias("kurtosis")).alias(c))
    long = _long(df.agg(*exprs), cols, "s")
    medians = df.sparkSession.createDataFrame([(c, None if med[c][0] is None else float(med[c][0])) for c in cols],
                                              "column_name string, median double")
    return long.join(F.broadcast(medians), "column_name").select(
        "column_name", "s.n", "s.mean", "median", "s.std", "s.skewness", "s.kurtosis")


def normality_test(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """D'Agostino-Pearson K2 and p-value per numeric column (null below n = 8).

    The moments are one fused aggregate; the closed form runs on the aggregated row."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    exprs = [F.struct(F.count(as_double(c)).alias("n"), F.skewness(as_double(c)).alias("g1"),
                      F.kurtosis(as_double(c)).alias("g2")).alias(c) for c in cols]
    row = df.agg(*exprs).first() if cols else None
    out = []
    for c in cols:
        m = row[c]
        if m["n"] is None or m["n"] < 8 or m["g1"] is None or m["g2"] is None:
            out.append((c, None, None, None, None))
        else:
            out.append((c,) + tuple(float(v) for v in dagostino_k2(m["g1"], m["g2"], m["n"])))
    return df.sparkSession.createDataFrame(
        out, "column_name string, z_skew double, z_kurtosis double, statistic double, p_value double")


def skew_kurtosis_table(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, skew G1, kurtosis G2): pandas' sample-adjusted estimators."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    exprs = [F.struct(F.count(as_double(c)).alias("n"), F.skewness(as_double(c)).alias("g1"),
                      F.kurtosis(as_double(c)).alias("g2")).alias(c) for c in cols]
    long = _long(df.agg(*exprs), cols, "s")
    return long.select("column_name", adjusted_skew(F.col("s.g1"), F.col("s.n")).alias("skew"),
                       adjusted_kurtosis(F.col("s.g2"), F.col("s.n")).alias("kurtosis"))


def categorical_profile(df: DataFrame, col: str) -> DataFrame:
    """(value, count, n_distinct) in descending count order, nulls dropped."""
    counts = df.where(qcol(col).isNotNull()).groupBy(qcol(col).alias("value")).count()
    nd = df.agg(F.count_distinct(qcol(col))).first()[0]
    return counts.withColumn("n_distinct", F.lit(nd).cast("bigint")).orderBy(F.desc("count"), F.asc("value"))


def countplot_data(df: DataFrame, col: str) -> DataFrame:
    """Category counts in descending order (the data under a count plot)."""
    return (df.where(qcol(col).isNotNull()).groupBy(qcol(col).alias("value")).count()
            .orderBy(F.desc("count"), F.asc("value")))


def histogram_bins(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram over [min, max]: (bin, lower, upper, count, density).

    The last bin is closed on the right. One min/max job, then one grouped count."""
    x = as_double(col)
    mm = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n")).first()
    spark = df.sparkSession
    if mm["n"] == 0:
        return spark.createDataFrame([], "bin int, lower double, upper double, count bigint, density double")
    lo, hi, n = mm["lo"], mm["hi"], mm["n"]
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).count()
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(counts, "bin", "left")
            .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))
            .withColumn("density", F.col("count") / F.lit(n * width)))


def boxplot_stats(df: DataFrame, cols: Sequence[str] | None = None, whis: float = 1.5,
                  relative_error: float | None = None) -> DataFrame:
    """(column_name, q1, median, q3, whisker_low, whisker_high, n_outliers); columns with
    at most one distinct value are skipped, as no box is drawn for them."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    varies = df.agg(*[(F.min(qcol(c)) < F.max(qcol(c))).alias(c) for c in cols]).first() if cols else {}
    cols = [c for c in cols if varies[c]]
    spark = df.sparkSession
    schema = ("column_name string, q1 double, median double, q3 double, whisker_low double, "
              "whisker_high double, n_outliers bigint")
    if not cols:
        return spark.createDataFrame([], schema)
    qs = quantiles(df, cols, [0.25, 0.5, 0.75], relative_error)
    exprs = []
    for c in cols:
        q1, med, q3 = qs[c]
        lo, hi = q1 - whis * (q3 - q1), q3 + whis * (q3 - q1)
        x = as_double(c)
        inside = (x >= lo) & (x <= hi)
        exprs.append(F.struct(F.lit(q1).cast("double").alias("q1"), F.lit(med).cast("double").alias("median"),
                              F.lit(q3).cast("double").alias("q3"), F.min(F.when(inside, x)).alias("whisker_low"),
                              F.max(F.when(inside, x)).alias("whisker_high"),
                              F.count_if((x < lo) | (x > hi)).alias("n_outliers")).alias(c))
    return _long(df.agg(*exprs), cols, "s").select("column_name", "s.*")


def distribution_compare(df: DataFrame, sample: DataFrame, col: str, kind: str = "numeric", bins: int = 30,
                         top: int = 10) -> DataFrame:
    """The same histogram (numeric) or top-k category counts (categorical) for the table
    and a sample, stacked with a ``source`` column."""
    if kind == "numeric":
        x = as_double(col)
        mm = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
        lo, hi = mm["lo"], mm["hi"]
        width = (hi - lo) / bins if hi is not None and hi > lo else 1.0

        def hist(d, name):
            b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
            return (d.where(x.isNotNull()).groupBy(b.cast("string").alias("bucket")).count()
                    .withColumn("source", F.lit(name)))
        return hist(df, "table").unionByName(hist(sample, "sample"))
    from .relational import top_k_values
    top_vals = top_k_values(df, col, top).select(F.col("value").alias("bucket"))

    def cats(d, name):
        c = d.where(qcol(col).isNotNull()).groupBy(qcol(col).cast("string").alias("bucket")).count()
        return c.join(F.broadcast(top_vals), "bucket", "left_semi").withColumn("source", F.lit(name))
    return cats(df, "table").unionByName(cats(sample, "sample"))


def filling_percentage(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, filled_pct) = 100 * non-null / rows, descending."""
    cols = list(cols) if cols is not None else df.columns
    n = F.count(F.lit(1))
    out = _long(df.agg(*[(F.count(qcol(c)) * 100.0 / n).alias(c) for c in cols]), cols, "filled_pct")
    return out.orderBy(F.desc("filled_pct"), F.asc("column_name"))


def filling_band(df: DataFrame, lo: float, hi: float, cols: Sequence[str] | None = None) -> DataFrame:
    """Columns whose fill rate lies in [lo, hi) (hi = 100 is inclusive), with a band label."""
    fp = filling_percentage(df, cols)
    upper = (F.col("filled_pct") <= hi) if hi >= 100 else (F.col("filled_pct") < hi)
    return fp.where((F.col("filled_pct") >= lo) & upper)
