"""Apply fitted preparation steps to streaming DataFrames.

The reference has no stream processing, and none is added here. What this module gives
is the transform half of the fit / transform split: statistics are fitted once on a
batch DataFrame (one aggregate job each) and frozen into literal Column expressions,
which are stateless and therefore valid on a ``readStream`` DataFrame (no state store,
no watermark needed)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import as_double, numeric_columns, quantiles, tukey_fences
from ..operators.scale import fit_moments


def fit_scaler(df: DataFrame, kind: str = "standard", cols: Sequence[str] | None = None) -> dict[str, Column]:
    """{column: expression} for the null-as-0 standard / minmax / robust scalers."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    x = {c: F.coalesce(as_double(c), F.lit(0.0)) for c in cols}
    if kind == "robust":
        src = df.select(*[x[c].alias(c) for c in cols])
        q = quantiles(src, cols, [0.25, 0.5, 0.75])
        return {c: (x[c] - F.lit(q[c][1])) / F.lit((q[c][2] - q[c][0]) or 1.0) for c in cols if q[c][1] is not None}
    m = fit_moments(df, cols, True)
    if kind == "standard":
        return {c: (x[c] - F.lit(m[c]["mean"])) / F.lit(m[c]["std_pop"] or 1.0) for c in cols if m[c]["mean"] is not None}
    if kind == "minmax":
        return {c: (x[c] - F.lit(m[c]["min"])) / F.lit((m[c]["max"] - m[c]["min"]) or 1.0)
                for c in cols if m[c]["min"] is not None}
    raise ValueError(f"unknown scaler {kind!r}")


def fit_fill(df: DataFrame, strategy: str = "mean", cols: Sequence[str] | None = None) -> dict[str, Column]:
    """{column: coalesce(column, fitted mean / median)}."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    if strategy == "mean":
        row = df.agg(*[F.avg(as_double(c)).alias(c) for c in cols]).first()
        vals = {c: row[c] for c in cols}
    elif strategy == "median":
        vals = {c: v[0] for c, v in quantiles(df, cols, [0.5]).items()}
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return {c: F.coalesce(as_double(c), F.lit(v)) for c, v in vals.items() if v is not None}


def fit_tukey_flags(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> dict[str, Column]:
    """{outlier_tukey_<col>: 0/1 flag} with fences fitted on the batch."""
    out = {}
    for c, (_, _, lo, hi) in tukey_fences(df, cols, k).items():
        if lo is not None:
            out[f"outlier_tukey_{c}"] = F.coalesce((as_double(c) < lo) | (as_double(c) > hi), F.lit(False)).cast("int")
    return out


def apply_fitted(df: DataFrame, *fitted: dict[str, Column]) -> DataFrame:
    """Apply one or more fitted expression maps in order (batch or streaming)."""
    out = df
    for exprs in fitted:
        out = out.withColumns(exprs)
    return out
