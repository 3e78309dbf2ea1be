"""Missing-value imputation (inventory 2.7).

Fill values are fitted by one aggregate job (means, exact medians, regression moments)
and applied as literals in one projection. Regression imputation solves the normal
equations from one covariance aggregate, so training is a single distributed pass
whatever the row count; only the d x d system reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.linalg import summed_arrays
from ..functions.stats import as_double, numeric_columns, qcol, quantiles
from ..session import cut_lineage


def _numeric_with_nulls(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    if not cols:
        return {}
    row = df.agg(*[F.count_if(qcol(c).isNull()).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def _fill(df: DataFrame, values: dict) -> DataFrame:
    """coalesce each column with its fill value. A numeric column holding nulls becomes
    double (in pandas such a column is already float)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    repl = {}
    for c, v in values.items():
        if v is None:
            continue
        if isinstance(types[c], T.NumericType):
            repl[c] = F.coalesce(as_double(c), F.lit(float(v)))
        else:
            repl[c] = F.coalesce(qcol(c), F.lit(v).cast(types[c]))
    return df.withColumns(repl) if repl else df


def impute_mean(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Numeric columns only, by default those that hold nulls; string columns untouched."""
    cols = list(cols) if cols is not None else [c for c, n in _numeric_with_nulls(df, numeric_columns(df)).items() if n]
    if not cols:
        return df
    row = df.agg(*[F.avg(as_double(c)).alias(c) for c in cols]).first()
    return _fill(df, {c: row[c] for c in cols})


def impute_median(df: DataFrame, cols: Sequence[str] | None = None, relative_error: float | None = None) -> DataFrame:
    """Exact median (linear interpolation) per numeric column, by default of those that hold nulls."""
    cols = list(cols) if cols is not None else [c for c, n in _numeric_with_nulls(df, numeric_columns(df)).items() if n]
    if not cols:
        return df
    q = quantiles(df, cols, [0.5], relative_error)
    return _fill(df, {c: q[c][0] for c in cols})


def column_mode(df: DataFrame, col: str):
    """Most frequent non-null value, smallest on ties. Grouped count (partial aggregation
    absorbs a hot value), then a TakeOrdered of one row."""
    row = (df.where(qcol(col).isNotNull()).groupBy(qcol(col).alias("v")).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), F.asc("v")).limit(1).first())
    return None if row is None else row["v"]


def column_modes(df: DataFrame, cols: Sequence[str]) -> dict:
    """Mode of many columns at once, smallest on ties: one stacked (column, value) count
    per type family, then a per-column min over (-count, value) — both partial
    aggregates, so neither a hot value nor a high-cardinality column lands in one task."""
    types = {f.name: f.dataType for f in df.schema.fields}
    families = {"double": [c for c in cols if isinstance(types[c], T.FractionalType) and not isinstance(types[c], T.DecimalType)],
                "bigint": [c for c in cols if isinstance(types[c], T.IntegralType)],
                "string": [c for c in cols if isinstance(types[c], T.StringType)]}
    out = {c: column_mode(df, c) for c in cols if not any(c in f for f in families.values())}
    for cast, cs in families.items():
        if not cs:
            continue
        stacked = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("c"), qcol(c).cast(cast).alias("v"))
                                               for c in cs]))).where(F.col("v").isNotNull())
        counts = stacked.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("c").agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col("v").alias("v"))).alias("b"))
        out.update({r["c"]: r["v"] for r in best.select("c", "b.v").collect()})
    return out


def impute_mode(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Every column (strings too) filled with its mode."""
    cols = list(cols) if cols is not None else df.columns
    nulls = _numeric_with_nulls(df, cols)
    need = [c for c in cols if nulls[c] > 0]
    return _fill(df, column_modes(df, need)) if need else df


def impute_drop(df: DataFrame) -> DataFrame:
    return df.dropna(how="any")


def impute_cca(df: DataFrame, col: str) -> DataFrame:
    """Complete-case analysis on one column."""
    return df.dropna(subset=[col]) if col in df.columns else df


def impute_arbitrary(df: DataFrame, col: str, value: float = 0) -> DataFrame:
    return _fill(df, {col: value}) if col in df.columns else df


def impute_mark(df: DataFrame, col: str, marker: str = "Imputed") -> DataFrame:
    """Null becomes the marker string; the column becomes a string column."""
    return df.withColumn(col, F.coalesce(qcol(col).cast("string"), F.lit(marker)))


# --------------------------------------------------------------------------- regression
def fit_ols(df: DataFrame, target: str, features: Sequence[str]) -> dict | None:
    """Ordinary least squares on rows where target and every feature are present, from
    one aggregate of means and population covariances (numerically stable merges)."""
    feats = list(features)
    cond = qcol(target).isNotNull()
    for f in feats:
        cond = cond & qcol(f).isNotNull()
    x = [F.when(cond, as_double(f)) for f in feats]
    y = F.when(cond, as_double(target))
    exprs = [F.count(y).alias("n"), F.avg(y).alias("my")]
    exprs += [F.avg(xi).alias(f"mx{i}") for i, xi in enumerate(x)]
    exprs += [F.covar_pop(xi, y).alias(f"cxy{i}") for i, xi in enumerate(x)]
    for i in range(len(x)):
        for j in range(i, len(x)):
            exprs.append(F.covar_pop(x[i], x[j]).alias(f"c{i}_{j}"))
    row = df.agg(*exprs).first()
    if not row["n"]:
        return None
    d = len(feats)
    cxx = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            cxx[i, j] = cxx[j, i] = row[f"c{i}_{j}"]
    cxy = np.array([row[f"cxy{i}"] for i in range(d)])
    beta = np.linalg.lstsq(cxx, cxy, rcond=None)[0]
    mx = np.array([row[f"mx{i}"] for i in range(d)])
    intercept = row["my"] - float(beta @ mx)
    return {"coef": dict(zip(feats, map(float, beta))), "intercept": float(intercept), "n": row["n"]}


def predict_expr(model: dict):
    expr = F.lit(model["intercept"])
    for f, b in model["coef"].items():
        expr = expr + F.lit(b) * as_double(f)
    return expr


def impute_linear_regression(df: DataFrame, col: str, features: Sequence[str] | None = None) -> DataFrame:
    """Fill ``col`` from an OLS fit on the other numeric columns. Fewer than two known
    values: mean; no feature: median; rows whose features hold a null stay null."""
    x = as_double(col)
    known = df.agg(F.count(x)).first()[0]
    if known < 2:
        return impute_mean(df, [col])
    feats = list(features) if features is not None else [c for c in numeric_columns(df) if c != col]
    if not feats:
        return impute_median(df, [col])
    model = fit_ols(df, col, feats)
    if model is None:
        return df
    return df.withColumn(col, F.coalesce(x, predict_expr(model)))


GRAM_LIMIT = 20_000_000  # numbers of all patterns' matrices that may reach the driver


def _pattern_grams(df: DataFrame, cols: Sequence[str], mean: np.ndarray, std: np.ndarray) -> DataFrame:
    """(pattern, g): per missing-value pattern the Gram matrix, flattened, of [1, standardised values with 0 for missing]."""
    d = len(cols)

    def part(batches):
        grams: dict[str, np.ndarray] = {}
        for pdf in batches:
            z = (pdf.to_numpy(dtype=float) - mean) / std
            gone = np.isnan(z)
            u = np.hstack([np.ones((len(z), 1)), np.where(gone, 0.0, z)])
            kinds, of = np.unique(gone, axis=0, return_inverse=True)
            for i, kind in enumerate(kinds):
                mine, name = u[of.ravel() == i], "".join("1" if g else "0" for g in kind)
                grams[name] = grams.get(name, 0.0) + mine.T @ mine
            if len(grams) * (d + 1) ** 2 > GRAM_LIMIT // 20:
                yield pd.DataFrame({"pattern": list(grams), "g": [g.ravel() for g in grams.values()]})
                grams = {}
        if grams:
            yield pd.DataFrame({"pattern": list(grams), "g": [g.ravel() for g in grams.values()]})

    return summed_arrays(df.select(*[as_double(c).alias(f"x{i}") for i, c in enumerate(cols)])
                         .mapInPandas(part, "pattern string, g array<double>"), ["pattern"], "g")


def _chain(patterns: list[str], grams: np.ndarray, tol: float, max_rounds: int) -> np.ndarray:
    """Per pattern the linear map from [1, values with 0 for missing] to the completed [1, values].

    Regressions are linear, so all rows of a pattern are completed by one map, and the matrix of sums that a
    regression needs is the sum of the patterns' matrices under their maps: rounds cost no scan."""
    gone = np.array([[False, *(ch == "1" for ch in p)] for p in patterns])
    full = np.eye(gone.shape[1])[None] * ~gone[:, :, None]
    for _ in range(max_rounds):
        most = 0.0
        for c in range(1, gone.shape[1]):
            mine = gone[:, c]
            rows = grams[mine][:, 0, 0].sum()
            if not mine.any() or mine.all():
                continue
            known = full[~mine]
            sums = (known @ grams[~mine] @ known.transpose(0, 2, 1)).sum(0)
            others = [i for i in range(gone.shape[1]) if i != c]
            beta = np.linalg.lstsq(sums[np.ix_(others, others)], sums[others, c], rcond=None)[0]
            new = np.einsum("i,pij->pj", beta, full[mine][:, others])
            step = new - full[mine, c]
            most = max(most, float(np.sqrt(max(np.einsum("pi,pij,pj->", step, grams[mine], step), 0.0) / rows)))
            full[mine, c] = new
        if most <= tol:
            break
    return full


def _chain_by_scans(df: DataFrame, cols: Sequence[str], std: np.ndarray, tol: float, max_rounds: int) -> DataFrame:
    """The same regressions with one scan each, for tables of very many missing-value patterns."""
    missing = {c: f"__miss_{i}" for i, c in enumerate(cols)}
    out = impute_mean(df.withColumns({m: qcol(c).isNull() for c, m in missing.items()}), cols)
    for _ in range(max_rounds):
        before = {c: f"__old_{i}" for i, c in enumerate(cols)}
        out = out.withColumns({o: as_double(c) for c, o in before.items()})
        for c in cols:
            model = fit_ols(out.where(~F.col(missing[c])), c, [o for o in cols if o != c])
            if model is not None:
                out = out.withColumn(c, F.when(F.col(missing[c]), predict_expr(model)).otherwise(as_double(c)))
        out = cut_lineage(out)
        moved = out.agg(*[F.avg(F.when(F.col(missing[c]), F.pow((as_double(c) - F.col(before[c])) / F.lit(float(s)), 2))).alias(before[c])
                          for c, s in zip(cols, std, strict=True)]).first()
        out = out.drop(*before.values())
        if all(v is None or v <= tol * tol for v in moved):
            break
    return out.drop(*missing.values())


def impute_iterative(df: DataFrame, cols: Sequence[str] | None = None, tol: float = 1e-6, max_rounds: int = 200) -> DataFrame:
    """Chained equations: mean fill, then each column's originally missing cells are predicted again from the others,
    column by column, until no column's fills move by more than ``tol`` standard deviations (root mean square).

    One scan takes the sums of every missing-value pattern; the rounds run on these d x d matrices (``_chain``), and
    one projection fills the cells. Only where the patterns' matrices exceed ``GRAM_LIMIT`` numbers is every round a
    scan. Columns without any value stay null and take no part; a NaN counts as missing."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    clean = {c: F.nanvl(as_double(c), F.lit(None).cast("double")) for c in cols}
    df = df.withColumns(clean)
    fits = df.agg(*[f(as_double(c)).alias(f"{n}{i}") for i, c in enumerate(cols) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first() if cols else None
    live = [i for i in range(len(cols)) if fits[f"m{i}"] is not None]
    if len(live) < 2:
        return impute_mean(df, [cols[i] for i in live]) if live else df
    used = [cols[i] for i in live]
    mean = np.array([fits[f"m{i}"] for i in live])
    std = np.array([fits[f"s{i}"] or 1.0 for i in live])
    d = len(used)
    table = _pattern_grams(df, used, mean, std).persist()
    n_patterns = table.count()
    if n_patterns * (d + 1) ** 2 > GRAM_LIMIT:
        table.unpersist()
        return _chain_by_scans(df, used, std, tol, max_rounds)
    rows = sorted(table.collect(), key=lambda r: r.pattern)
    table.unpersist()
    full = _chain([r.pattern for r in rows], np.array([r.g for r in rows]).reshape(-1, d + 1, d + 1), tol, max_rounds)
    maps = df.sparkSession.createDataFrame([(r.pattern, m.tolist()) for r, m in zip(rows, full, strict=True) if "1" in r.pattern],
                                           "__pattern string, __map array<array<double>>")
    z = [F.coalesce((as_double(c) - F.lit(float(m))) / F.lit(float(s)), F.lit(0.0)) for c, m, s in zip(used, mean, std, strict=True)]
    marked = df.withColumn("__pattern", F.concat(*[F.when(qcol(c).isNull(), "1").otherwise("0") for c in used])).withColumn("__u", F.array(F.lit(1.0), *z))
    joined = marked.join(maps, "__pattern", "left")
    fill = lambda i: F.aggregate(F.zip_with(F.col("__map")[i + 1], F.col("__u"), lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)
    place = {c: i for i, c in enumerate(used)}
    return joined.select(*[F.coalesce(as_double(c), F.lit(float(mean[place[c]])) + F.lit(float(std[place[c]])) * fill(place[c])).alias(c)
                           if c in place else qcol(c) for c in df.columns])


# --------------------------------------------------------------------------- ratios / groups
def impute_from_ratio_mean(df: DataFrame, a: str, b: str) -> DataFrame:
    """ratio = mean of finite a/b per row; then b = a / ratio where b is missing."""
    ratio = df.agg(F.avg(F.try_divide(as_double(a), as_double(b)))).first()[0]
    if ratio is None or ratio == 0:
        return df
    return df.withColumn(b, F.coalesce(as_double(b), as_double(a) / F.lit(ratio)))


def impute_from_ratio_of_means(df: DataFrame, a: str, b: str) -> DataFrame:
    """ratio = mean(a) / mean(b); then b = a / ratio where b is missing."""
    row = df.agg(F.avg(as_double(a)).alias("ma"), F.avg(as_double(b)).alias("mb")).first()
    if row["ma"] is None or not row["mb"] or row["ma"] == 0:
        return df
    ratio = row["ma"] / row["mb"]
    return df.withColumn(b, F.coalesce(as_double(b), as_double(a) / F.lit(ratio)))


def impute_group_mean(df: DataFrame, col: str, group: str, min_group_rows: int = 2) -> DataFrame:
    """Fill from the mean of the row's category; categories with fewer than
    ``min_group_rows`` rows give no fill. Aggregate + equi join (AQE picks the strategy)."""
    stats = (df.where(qcol(group).isNotNull()).groupBy(qcol(group).alias("__g"))
             .agg(F.avg(as_double(col)).alias("__m"), F.count(F.lit(1)).alias("__n"))
             .where(F.col("__n") >= min_group_rows).drop("__n"))
    joined = df.join(stats, qcol(group) == F.col("__g"), "left")
    return joined.select(*[F.coalesce(as_double(c), F.col("__m")).alias(c) if c == col else qcol(c)
                           for c in df.columns])


# --------------------------------------------------------------------------- dispatcher
def first_column_with_null(df: DataFrame) -> str | None:
    row = df.agg(*[F.count_if(qcol(c).isNull()).alias(c) for c in df.columns]).first()
    return next((c for c in df.columns if row[c] > 0), None)


def impute_missing_values(df: DataFrame, method: str = "mean", col: str | None = None, **kw) -> DataFrame:
    """Dispatch by method name over lower-cased column names; the default column is the
    first one holding a null. Unknown methods are an error."""
    from .neighbours import impute_knn

    df = df.toDF(*[c.lower() for c in df.columns])
    col = col.lower() if col else first_column_with_null(df)
    table_wide = {"mean": impute_mean, "median": impute_median, "mode": impute_mode, "frequent": impute_mode,
                  "drop": lambda d, **k: impute_drop(d), "knn": impute_knn, "iterative": impute_iterative}
    per_column = {"cca": impute_cca, "arbitrary": impute_arbitrary, "linear_regression": impute_linear_regression,
                  "mark": impute_mark}
    if method in table_wide:
        return table_wide[method](df, **kw)
    if method in per_column:
        if col is None:
            return df
        return per_column[method](df, col, **kw)
    raise ValueError(f"unknown method {method!r}; choose from {sorted(table_wide) + sorted(per_column)}")
