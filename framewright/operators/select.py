"""Column selection by statistics (inventory 2.4). Every selector is one fused
aggregate whose small result decides the projected schema on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import as_double, numeric_columns, qcol, safe_corr


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation, pairwise-complete, all ordered pairs in one aggregate:
    (col_a, col_b, corr). A constant column gives null, not an error."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[safe_corr(a, b).alias(f"p{k}") for k, (a, b) in enumerate(pairs)]).first() if pairs else None
    vals = {}
    for k, (a, b) in enumerate(pairs):
        vals[(a, b)] = vals[(b, a)] = row[f"p{k}"]
    rows = [(a, b, None if vals[(a, b)] is None else float(vals[(a, b)])) for a in cols for b in cols]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, corr double")


def _corr_dict(df: DataFrame, cols: Sequence[str]) -> dict:
    return {(r.col_a, r.col_b): r.corr for r in correlation_matrix(df, cols).collect()}


def drop_low_correlation(df: DataFrame, min_corr: float = 0.1, cols: Sequence[str] | None = None,
                         exclude_self: bool = True) -> DataFrame:
    """Drop numeric columns whose every absolute correlation with another column is below
    ``min_corr`` (nulls count as below). ``exclude_self=False`` keeps the diagonal in the
    test, as the reference does, which then drops only constant columns."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    corr = _corr_dict(df, cols)
    drop = []
    for a in cols:
        vals = [corr[(a, b)] for b in cols if not (exclude_self and a == b)]
        if not any(v is not None and abs(v) >= min_corr for v in vals):
            drop.append(a)
    return df.drop(*drop)


def drop_high_correlation(df: DataFrame, threshold: float = 0.8, cols: Sequence[str] | None = None) -> DataFrame:
    """Upper triangle: drop a column when any earlier column has |corr| > threshold."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    corr = _corr_dict(df, cols)
    drop = [b for j, b in enumerate(cols)
            if any(corr[(a, b)] is not None and abs(corr[(a, b)]) > threshold for a in cols[:j])]
    return df.drop(*drop)


def null_ratios(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, float]:
    cols = list(cols) if cols is not None else df.columns
    n = F.count(F.lit(1))
    row = df.agg(*[(F.count_if(qcol(c).isNull()) / n).alias(c) for c in cols]).first()
    return {c: (row[c] or 0.0) for c in cols}


def drop_sparse_columns(df: DataFrame, max_missing: float = 0.2, cols: Sequence[str] | None = None,
                        inclusive: bool = False) -> DataFrame:
    """Drop columns whose null ratio is above ``max_missing`` (at or above when inclusive)."""
    ratios = null_ratios(df, cols)
    drop = [c for c, r in ratios.items() if (r >= max_missing if inclusive else r > max_missing)]
    return df.drop(*drop)


def drop_low_variance(df: DataFrame, min_variance: float = 0.1, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop numeric columns whose population variance (non-nulls) is below the minimum."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    if not cols:
        return df
    row = df.agg(*[F.var_pop(as_double(c)).alias(c) for c in cols]).first()
    return df.drop(*[c for c in cols if row[c] is None or row[c] < min_variance])


SELECTORS = {"variance": "drop_low_variance", "missing": "drop_sparse_columns", "correlation": "drop_low_correlation"}


def filter_irrelevant_columns(df: DataFrame, methods: Sequence[str] = ("variance", "missing", "correlation"),
                              min_variance: float = 0.1, max_missing: float = 0.2, min_corr: float = 0.1) -> DataFrame:
    """Run the named selectors in the given order."""
    out = df
    for m in methods:
        if m == "variance":
            out = drop_low_variance(out, min_variance)
        elif m == "missing":
            out = drop_sparse_columns(out, max_missing)
        elif m == "correlation":
            out = drop_low_correlation(out, min_corr)
        else:
            raise ValueError(f"unknown method {m!r}; choose from {sorted(SELECTORS)}")
    return out
