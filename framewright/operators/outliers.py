"""Outlier flags and treatment (inventory 2.8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import as_double, numeric_columns, qcol, quantiles, tukey_fences
from ..session import cut_lineage


def tukey_flag(df: DataFrame, col: str, k: float = 1.5, relative_error: float | None = None) -> DataFrame:
    """0/1 column ``outlier_tukey_<col>``: strictly outside the fences; null gives 0."""
    _, _, lo, hi = tukey_fences(df, [col], k, relative_error)[col]
    x = as_double(col)
    flag = F.coalesce((x < F.lit(lo)) | (x > F.lit(hi)), F.lit(False)) if lo is not None else F.lit(False)
    return df.withColumn(f"outlier_tukey_{col}", flag.cast("int"))


def zscore_flag(df: DataFrame, col: str, threshold: float = 3.0, nan_policy: str = "omit") -> DataFrame:
    """0/1 column ``outlier_zscore_<col>``: |x - mean| / population std > threshold.

    ``omit`` computes over non-nulls (null flag 0); ``propagate`` reproduces the
    all-zero result when the column holds any null."""
    x = as_double(col)
    row = df.agg(F.avg(x).alias("m"), F.stddev_pop(x).alias("s"), F.count_if(x.isNull()).alias("nn")).first()
    name = f"outlier_zscore_{col}"
    if row["m"] is None or not row["s"] or (nan_policy == "propagate" and row["nn"] > 0):
        return df.withColumn(name, F.lit(0))
    z = F.abs((x - F.lit(row["m"])) / F.lit(row["s"]))
    return df.withColumn(name, F.coalesce(z > threshold, F.lit(False)).cast("int"))


def outlier_summary(df: DataFrame, col: str, with_iforest: bool = False, key: str | None = None) -> DataFrame:
    """(column_name, n_tukey, n_zscore[, n_iforest]): flag counts per method in one job.
    ``with_iforest`` adds the isolation-forest count (needs a row key)."""
    flagged = zscore_flag(tukey_flag(df, col), col)
    counts = [F.sum(f"outlier_tukey_{col}").cast("bigint").alias("n_tukey"),
              F.sum(f"outlier_zscore_{col}").cast("bigint").alias("n_zscore")]
    if with_iforest:
        from .iforest import isolation_forest_flag
        if key is None:
            raise ValueError("the isolation-forest count needs a key column")
        flagged = isolation_forest_flag(flagged, col, key)
        counts.append(F.sum(f"outlier_iforest_{col}").cast("bigint").alias("n_iforest"))
    return flagged.agg(F.lit(col).alias("column_name"), *counts)


def handle_outliers(df: DataFrame, col: str, strategy: str = "remove", value: float | None = None,
                    k: float = 1.5) -> DataFrame:
    """Treat Tukey outliers of one column: remove rows, or replace by the mean / median
    (computed over all non-null values, outliers included) or a given value."""
    _, _, lo, hi = tukey_fences(df, [col], k)[col]
    if lo is None:
        return df
    x = as_double(col)
    is_out = F.coalesce((x < F.lit(lo)) | (x > F.lit(hi)), F.lit(False))
    if strategy == "remove":
        return df.where(~is_out)
    if strategy == "impute_mean":
        fill = df.agg(F.avg(x)).first()[0]
    elif strategy == "impute_median":
        fill = quantiles(df, [col], [0.5])[col][0]
    elif strategy == "impute_value":
        if value is None:
            raise ValueError("impute_value needs a value")
        fill = value
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return df.withColumn(col, F.when(is_out, F.lit(float(fill))).otherwise(x))


def outlier_analysis(df: DataFrame, cols: Sequence[str] | None = None, strategy: str = "remove",
                     value: float | None = None, checkpoint_every: int = 8, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """For every numeric column in order: flag counts, then treatment. Column k's fences
    come from the rows left by columns < k. Returns (treated table, summary). The summary holds
    the Tukey and z-score counts and, with a row ``key``, the isolation-forest count (else null).

    Lineage is cut with a reliable checkpoint every ``checkpoint_every`` columns so a
    wide table does not recompute an ever longer chain."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    summaries = []
    out = df
    for i, c in enumerate(cols, start=1):
        x = as_double(c)
        # one quantile fit per column serves the flag counts and the treatment
        q1, med, q3 = quantiles(out, [c], [0.25, 0.5, 0.75])[c]
        m = out.agg(F.avg(x).alias("m"), F.stddev_pop(x).alias("s")).first()
        if q1 is None:
            summaries.append((c, 0, 0, 0 if key else None))
            continue
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        is_out = F.coalesce((x < F.lit(lo)) | (x > F.lit(hi)), F.lit(False))
        z_out = F.coalesce(F.abs((x - F.lit(m["m"])) / F.lit(m["s"])) > 3, F.lit(False)) if m["s"] else F.lit(False)
        s = out.agg(F.count_if(is_out).alias("t"), F.count_if(z_out).alias("z"), F.avg(x).alias("mean")).first()
        forest = None
        if key:
            from .iforest import isolation_forest_flag
            forest = isolation_forest_flag(out, c, key).agg(F.sum(f"outlier_iforest_{c}")).first()[0]
        summaries.append((c, s["t"], s["z"], forest))
        if strategy == "remove":
            out = out.where(~is_out)
        else:
            fill = {"impute_mean": s["mean"], "impute_median": med, "impute_value": value}.get(strategy)
            if strategy not in ("impute_mean", "impute_median", "impute_value") or fill is None:
                raise ValueError(f"unknown strategy {strategy!r} or missing value")
            out = out.withColumn(c, F.when(is_out, F.lit(float(fill))).otherwise(x))
        if checkpoint_every and i % checkpoint_every == 0 and i < len(cols):
            out = cut_lineage(out)
    summary = df.sparkSession.createDataFrame(summaries, "column_name string, n_tukey bigint, n_zscore bigint, n_iforest bigint")
    return out, summary


def outlier_scatter_data(df: DataFrame, key: str, col: str, k: float = 1.5) -> DataFrame:
    """(key, value, is_outlier) — the data under the outlier scatter plot."""
    flagged = tukey_flag(df, col, k)
    return flagged.select(qcol(key), qcol(col).alias("value"), F.col(f"outlier_tukey_{col}").alias("is_outlier"))
