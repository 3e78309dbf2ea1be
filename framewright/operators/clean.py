"""Projections, filters, predicates and row cleaning (inventory 2.3).

Row-local rules are Column expressions that fuse into one projection / filter and
push into the scan; data-dependent bounds are fitted by one aggregate job and then
inlined as literals.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import as_double, numeric_columns, qcol, quantiles, tukey_fences


# --------------------------------------------------------------------------- IQR
def iqr_outlier_rows(df: DataFrame, cols: Sequence[str] | None = None, k: float = 1.5,
                     relative_error: float | None = None) -> DataFrame:
    """Rows strictly outside [Q1 - k IQR, Q3 + k IQR], once per offending column, with
    the column's name in ``column_name``. One pass: an array of offending names is exploded."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    fences = tukey_fences(df, cols, k, relative_error)
    flags = []
    for c in cols:
        _, _, lo, hi = fences[c]
        if lo is None:
            continue
        x = as_double(c)
        flags.append(F.when((x < lo) | (x > hi), F.lit(c)))
    if not flags:
        return df.withColumn("column_name", F.lit(None).cast("string")).limit(0)
    names = F.filter(F.array(*flags), lambda v: v.isNotNull())
    return df.withColumn("__out", names).where(F.size("__out") > 0) \
             .select("*", F.explode("__out").alias("column_name")).drop("__out")


def iqr_remove(df: DataFrame, cols: Sequence[str] | None = None, k: float = 1.5, mode: str = "sequential",
               relative_error: float | None = None) -> DataFrame:
    """Keep rows with lower <= x <= upper (null rows dropped).

    ``sequential`` recomputes each column's fences on the rows surviving earlier columns
    (one quantile job per column); ``simultaneous`` fits all fences in one job."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    if mode == "simultaneous":
        fences = tukey_fences(df, cols, k, relative_error)
        cond = F.lit(True)
        for c in cols:
            _, _, lo, hi = fences[c]
            cond = cond & (as_double(c).between(lo, hi) if lo is not None else F.lit(False))
        return df.where(cond)
    out = df
    for c in cols:
        _, _, lo, hi = tukey_fences(out, [c], k, relative_error)[c]
        out = out.where(as_double(c).between(lo, hi)) if lo is not None else out.where(F.lit(False))
    return out


def iqr_clip(df: DataFrame, cols: Sequence[str] | None = None, k: float = 1.5,
             relative_error: float | None = None) -> DataFrame:
    """Clamp each column to its Tukey fences; nulls stay null."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    fences = tukey_fences(df, cols, k, relative_error)
    repl = {}
    for c in cols:
        _, _, lo, hi = fences[c]
        if lo is None:
            continue
        x = as_double(c)
        repl[c] = F.when(x < lo, F.lit(lo)).when(x > hi, F.lit(hi)).otherwise(x)
    return df.withColumns(repl) if repl else df


def iqr_row_mask(df: DataFrame, cols: Sequence[str] | None = None, k: float = 1.5,
                 relative_error: float | None = None) -> DataFrame:
    """Keep rows inside the fences in every column at once; a null passes."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    fences = tukey_fences(df, cols, k, relative_error)
    cond = F.lit(True)
    for c in cols:
        _, _, lo, hi = fences[c]
        if lo is None:
            continue
        x = as_double(c)
        cond = cond & (x.isNull() | x.between(lo, hi))
    return df.where(cond)


# --------------------------------------------------------------------------- value rules
def abs_correct(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols) if cols is not None else numeric_columns(df)
    return df.withColumns({c: F.abs(qcol(c)) for c in cols}) if cols else df


def range_validate(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Values outside [min, max] become null."""
    return df.withColumns({c: F.when(qcol(c).between(lo, hi), qcol(c)) for c, (lo, hi) in ranges.items()})


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(subset) if subset else None)


def threshold_to_null(df: DataFrame, col: str, cap: float) -> DataFrame:
    """value > cap becomes null; nulls stay."""
    return df.withColumn(col, F.when(~(qcol(col) > cap) | qcol(col).isNull(), qcol(col)))


def bounds_to_null_all(df: DataFrame, cols: Sequence[str], lo: float = 0.0, hi: float = 100.0) -> DataFrame:
    """Numeric coercion (bad text -> null) then values outside [lo, hi] become null, all
    columns in one projection."""
    repl = {}
    for c in cols:
        x = qcol(c).try_cast("double")
        repl[c] = F.when(x.between(lo, hi), x)
    return df.withColumns(repl)


def row_sum(cols: Sequence[str]) -> Column:
    """Null-skipping horizontal sum (0 when every value is null, as pandas)."""
    return sum((F.coalesce(as_double(c), F.lit(0.0)) for c in cols), F.lit(0.0))


def row_null_count(cols: Sequence[str]) -> Column:
    return sum((qcol(c).isNull().cast("int") for c in cols), F.lit(0))


def horizontal_sum_filter(df: DataFrame, cols: Sequence[str], lo: float = 0.0, hi: float = 100.0) -> DataFrame:
    s = row_sum(cols)
    return df.where((s >= lo) & (s <= hi))


def horizontal_missing_filter(df: DataFrame, cols: Sequence[str], max_missing: int = 3) -> DataFrame:
    """Keep rows with fewer than ``max_missing`` nulls across ``cols``."""
    return df.where(row_null_count(cols) < max_missing)


def missing_count_distribution(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(n_missing, n_rows): how many rows miss 0, 1, 2, ... of the columns."""
    return df.groupBy(row_null_count(cols).alias("n_missing")).agg(F.count(F.lit(1)).alias("n_rows"))


def drop_all_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="all", subset=list(subset) if subset else None)


def drop_any_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=list(subset) if subset else None)


def blank_string_filter(df: DataFrame, col: str) -> DataFrame:
    """Keep rows whose string is non-null and not only whitespace."""
    return df.where(qcol(col).isNotNull() & ~qcol(col).rlike(r"^\s*$"))


def either_present_filter(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.where(qcol(a).isNotNull() | qcol(b).isNotNull())


def only_in_a_count(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows where ``a`` is set and ``b`` is missing."""
    return df.agg(F.count_if(qcol(a).isNotNull() & qcol(b).isNull()).alias("n_only_a"))


def value_to_null(df: DataFrame, cols: Sequence[str], sentinel: str = "unknown") -> DataFrame:
    """A sentinel string becomes null."""
    return df.withColumns({c: F.nullif(qcol(c), F.lit(sentinel)) for c in cols})


def regex_filter_rows(df: DataFrame, col: str, pattern: str, case_insensitive: bool = True) -> DataFrame:
    """Keep rows whose string contains the pattern; null rows are dropped."""
    p = f"(?i){pattern}" if case_insensitive else pattern
    return df.where(F.coalesce(qcol(col).rlike(p), F.lit(False)))


# --------------------------------------------------------------------------- funnel
def cleaning_funnel(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Surviving row count after each ordered, row-local filter — all in one scan.

    Output (step, name, n_rows) with step 0 = input rows."""
    exprs = [F.count(F.lit(1)).alias("s0")]
    cond = F.lit(True)
    for i, (_, pred) in enumerate(steps, start=1):
        cond = cond & F.coalesce(pred, F.lit(False))
        exprs.append(F.count_if(cond).alias(f"s{i}"))
    names = ["input"] + [n for n, _ in steps]
    row = df.agg(*exprs)
    stacked = F.inline(F.array(*[F.struct(F.lit(i).alias("step"), F.lit(n).alias("name"),
                                          F.col(f"s{i}").alias("n_rows")) for i, n in enumerate(names)]))
    return row.select(stacked)


# --------------------------------------------------------------------------- schema edits
def select_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Explicit final list; absent names are ignored."""
    have = set(df.columns)
    return df.select(*[qcol(c) for c in wanted if c in have])


def columns_by_regex(df: DataFrame, suffix: str = "_100g", exclude_prefixes: Sequence[str] = ()) -> list[str]:
    """Column names ending with ``suffix`` and not starting with an excluded prefix."""
    neg = "".join(f"(?!{re.escape(p)})" for p in exclude_prefixes)
    rx = re.compile(f"^{neg}.*{re.escape(suffix)}$")
    return [c for c in df.columns if rx.match(c)]


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def set_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.withColumn(name, value)


def contains_column(df: DataFrame, name: str) -> bool:
    return name in df.columns


def _rename(df: DataFrame, fn) -> DataFrame:
    new = [fn(c) for c in df.columns]
    if len(set(new)) != len(new):
        dup = sorted({n for n in new if new.count(n) > 1})
        raise ValueError(f"column names collide after renaming: {dup}")
    return df.toDF(*new)


def lowercase_columns(df: DataFrame) -> DataFrame:
    return _rename(df, str.lower)


def strip_columns(df: DataFrame) -> DataFrame:
    return _rename(df, str.strip)


def narrow_numeric_types(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Cast numeric columns to the narrowest lossless type (one aggregate job)."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    if not cols:
        return df
    exprs = []
    for i, c in enumerate(cols):
        x = qcol(c)
        exprs += [F.min(x).cast("double").alias(f"mn{i}"), F.max(x).cast("double").alias(f"mx{i}"),
                  F.count_if(x.isNotNull() & (x.cast("float").cast("double") != x.cast("double"))).alias(f"fl{i}")]
    row = df.agg(*exprs).first()
    casts = {}
    ints = [("tinyint", 2 ** 7), ("smallint", 2 ** 15), ("int", 2 ** 31), ("bigint", 2 ** 63)]
    types = {f.name: f.dataType for f in df.schema.fields}
    for i, c in enumerate(cols):
        mn, mx = row[f"mn{i}"], row[f"mx{i}"]
        if mn is None:
            continue
        integral = isinstance(types[c], T.IntegralType)
        if integral:
            for name, lim in ints:
                if -lim <= mn and mx < lim:
                    casts[c] = name
                    break
        elif row[f"fl{i}"] == 0:
            casts[c] = "float"
    return df.withColumns({c: qcol(c).cast(t) for c, t in casts.items()}) if casts else df


def median_of(df: DataFrame, col: str) -> float | None:
    return quantiles(df, [col], [0.5])[col][0]
