"""Scaling (inventory 2.9). One fused aggregate fits every column; the transform is a
single projection with the fitted statistics inlined as literals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import adjusted_kurtosis, adjusted_skew, as_double, numeric_columns, quantiles


def _cols(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    return list(cols) if cols is not None else numeric_columns(df)


def _filled(c: str, fill_zero: bool):
    x = as_double(c)
    return F.coalesce(x, F.lit(0.0)) if fill_zero else x


def fit_moments(df: DataFrame, cols: Sequence[str], fill_zero: bool) -> dict:
    exprs = []
    for i, c in enumerate(cols):
        x = _filled(c, fill_zero)
        exprs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"sp{i}"), F.stddev_samp(x).alias(f"ss{i}"),
                  F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    row = df.agg(*exprs).first() if exprs else None
    return {c: {"mean": row[f"m{i}"], "std_pop": row[f"sp{i}"], "std_samp": row[f"ss{i}"],
                "min": row[f"lo{i}"], "max": row[f"hi{i}"]} for i, c in enumerate(cols)}


def _filled_quartiles(df: DataFrame, cols: Sequence[str], fill_zero: bool, relative_error=None) -> dict:
    src = df.select(*[_filled(c, fill_zero).alias(c) for c in cols]) if fill_zero else df
    return quantiles(src, cols, [0.25, 0.5, 0.75], relative_error)


def scale_standard(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null as 0, then (x - mean) / population std; a constant column becomes 0."""
    cols = _cols(df, cols)
    m = fit_moments(df, cols, True)
    return df.withColumns({c: (_filled(c, True) - F.lit(m[c]["mean"])) / F.lit(m[c]["std_pop"] or 1.0)
                           for c in cols if m[c]["mean"] is not None}) if cols else df


def scale_standard_sample(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Nulls kept, (x - mean) / sample std; columns with zero std are left unchanged."""
    cols = _cols(df, cols)
    m = fit_moments(df, cols, False)
    repl = {c: (as_double(c) - F.lit(m[c]["mean"])) / F.lit(m[c]["std_samp"]) for c in cols
            if m[c]["std_samp"] is not None and m[c]["std_samp"] > 0}
    return df.withColumns(repl) if repl else df


def scale_minmax(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null as 0, then to [0, 1]; a constant column becomes 0."""
    cols = _cols(df, cols)
    m = fit_moments(df, cols, True)
    repl = {}
    for c in cols:
        if m[c]["min"] is None:
            continue
        rng = m[c]["max"] - m[c]["min"]
        repl[c] = (_filled(c, True) - F.lit(m[c]["min"])) / F.lit(rng if rng > 0 else 1.0)
    return df.withColumns(repl) if repl else df


def scale_minmax_true(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Nulls kept; columns without range are left unchanged."""
    cols = _cols(df, cols)
    m = fit_moments(df, cols, False)
    repl = {c: (as_double(c) - F.lit(m[c]["min"])) / F.lit(m[c]["max"] - m[c]["min"]) for c in cols
            if m[c]["min"] is not None and m[c]["max"] - m[c]["min"] > 0}
    return df.withColumns(repl) if repl else df


def scale_robust(df: DataFrame, cols: Sequence[str] | None = None, relative_error: float | None = None) -> DataFrame:
    """Null as 0, then (x - median) / IQR; zero IQR divides by 1."""
    cols = _cols(df, cols)
    q = _filled_quartiles(df, cols, True, relative_error)
    repl = {}
    for c in cols:
        q1, med, q3 = q[c]
        if med is None:
            continue
        iqr = q3 - q1
        repl[c] = (_filled(c, True) - F.lit(med)) / F.lit(iqr if iqr != 0 else 1.0)
    return df.withColumns(repl) if repl else df


def scale_robust_true(df: DataFrame, cols: Sequence[str] | None = None,
                      relative_error: float | None = None) -> DataFrame:
    """Nulls kept; columns with zero IQR are left unchanged."""
    cols = _cols(df, cols)
    q = _filled_quartiles(df, cols, False, relative_error)
    repl = {}
    for c in cols:
        q1, med, q3 = q[c]
        if med is not None and q3 - q1 > 0:
            repl[c] = (as_double(c) - F.lit(med)) / F.lit(q3 - q1)
    return df.withColumns(repl) if repl else df


SCALERS = {"standard": scale_standard, "minmax": scale_minmax, "robust": scale_robust}


def scale_generic(df: DataFrame, scaler: str = "standard", cols: Sequence[str] | None = None) -> DataFrame:
    """Any of the null-as-0 scalers over all numeric columns."""
    if scaler not in SCALERS:
        raise ValueError(f"unknown scaler {scaler!r}; choose from {sorted(SCALERS)}")
    return SCALERS[scaler](df, cols)


def choose_scalers(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, str]:
    """Per column: |skew G1| > 1 -> robust; else |kurtosis G2| < 3 -> minmax; else standard."""
    cols = _cols(df, cols)
    exprs = []
    for i, c in enumerate(cols):
        x = as_double(c)
        exprs += [adjusted_skew(F.skewness(x), F.count(x)).alias(f"s{i}"),
                  adjusted_kurtosis(F.kurtosis(x), F.count(x)).alias(f"k{i}")]
    row = df.agg(*exprs).first() if exprs else None
    out = {}
    for i, c in enumerate(cols):
        s, k = row[f"s{i}"], row[f"k{i}"]
        if s is not None and abs(s) > 1:
            out[c] = "robust"
        elif k is not None and abs(k) < 3:
            out[c] = "minmax"
        else:
            out[c] = "standard"
    return out


def scale_auto(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distribution-driven choice per column; each column is scaled once, by its own rule."""
    choice = choose_scalers(df, cols)
    out = df
    for kind in ("robust", "minmax", "standard"):
        picked = [c for c, k in choice.items() if k == kind]
        if picked:
            out = SCALERS[kind](out, picked)
    return out


def normalize_l2_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Divide each column by its L2 norm (nulls count as 0 in the norm and stay null)."""
    cols = _cols(df, cols)
    if not cols:
        return df
    row = df.agg(*[F.sqrt(F.sum(F.pow(F.coalesce(as_double(c), F.lit(0.0)), 2))).alias(c) for c in cols]).first()
    return df.withColumns({c: F.try_divide(as_double(c), F.lit(row[c])) for c in cols})


def log1p_transform(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """log(1 + x) with null as 0; x <= -1 gives null."""
    cols = _cols(df, cols)
    return df.withColumns({c: F.log1p(F.coalesce(as_double(c), F.lit(0.0))) for c in cols}) if cols else df


