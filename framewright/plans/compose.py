"""Compositions of operators the reference exposes as one call: error resolution,
representative samples, and the outlier analysis report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.stats import numeric_columns, string_columns
from ..operators import clean as C
from ..operators import impute as I
from ..operators import relational as R
from ..operators import select as SEL


def resolve_errors(df: DataFrame, strategies: dict) -> DataFrame:
    """Apply the named fixes in the given order. Keys: missing_values ('drop' / 'mean' /
    'median' / 'mode'), duplicate_rows (any value), irrelevant_columns (list of names),
    outliers ('remove' / 'clip'), inconsistent_values (any value). Unknown keys are an error."""
    out = df
    missing = {"drop": I.impute_drop, "mean": I.impute_mean, "median": I.impute_median, "mode": I.impute_mode}
    for key, how in strategies.items():
        if key == "missing_values":
            if how not in missing:
                raise ValueError(f"unknown missing-value strategy {how!r}")
            out = missing[how](out)
        elif key == "duplicate_rows":
            out = C.drop_duplicates(out)
        elif key == "irrelevant_columns":
            out = out.drop(*list(how))
        elif key == "outliers":
            if how == "remove":
                out = C.iqr_remove(out)
            elif how == "clip":
                out = C.iqr_clip(out)
            else:
                raise ValueError(f"unknown outlier strategy {how!r}")
        elif key == "inconsistent_values":
            out = C.abs_correct(out)
        else:
            raise ValueError(f"unknown error type {key!r}")
    return out


def representative_sample(df: DataFrame, fraction: float = 0.1, seed: int = 42, stratify_by: str | None = None,
                          key: str | None = None, max_null_ratio: float = 0.9) -> DataFrame:
    """Sample (stratified when asked), drop columns at least ``max_null_ratio`` null, then
    impute: mode when any string column is left, mean otherwise."""
    if stratify_by:
        if key is None:
            raise ValueError("a stratified sample needs a key column")
        sample = R.sample_stratified(df, stratify_by, fraction, key, seed)
    else:
        sample = R.sample_fraction(df, fraction, seed)
    sample = SEL.drop_sparse_columns(sample, max_null_ratio, inclusive=True)
    return I.impute_mode(sample) if string_columns(sample) else I.impute_mean(sample)


def outlier_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per numeric column: Tukey and z-score counts (no treatment)."""
    from ..operators.outliers import outlier_summary

    cols = list(cols) if cols is not None else numeric_columns(df)
    parts = [outlier_summary(df, c) for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
