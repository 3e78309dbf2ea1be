"""Categorical encoding (inventory 2.10).

Each encoder is ``fit`` (an aggregate per category) then ``apply`` (an equi join back,
or a literal expression when the category set is provably small). After a rare-category
merge at share t there are at most 1/t + 1 categories, which is what bounds every
collect or broadcast here; without the merge the category table can be as large as the
data, so it is joined and AQE decides the strategy at runtime.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import as_double, qcol, string_columns

OTHER = "OTHER"


# --------------------------------------------------------------------------- rare merge
def frequent_categories(df: DataFrame, cols: Sequence[str], threshold: float = 0.01) -> dict[str, list]:
    """Per column, the values whose share of non-null rows is >= threshold (at most
    1/threshold of them, so the driver list is bounded)."""
    cols = list(cols)
    if not cols:
        return {}
    # two jobs for any number of columns: non-null totals, then one stacked (column, value)
    # count with partial aggregation, filtered against each column's total
    totals = df.agg(*[F.count(qcol(c)).alias(f"t{i}") for i, c in enumerate(cols)]).first()
    limit = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(threshold * totals[f"t{i}"]))])
    stacked = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("c"), qcol(c).cast("string").alias("v"))
                                           for c in cols]))).where(F.col("v").isNotNull())
    counts = stacked.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    kept = counts.where(F.col("n") >= limit[F.col("c")]).select("c", "v").collect()
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {c: [] for c in cols}
    for r in kept:
        out[r.c].append(r.v)
    for c in cols:  # restore the column's own type for isin
        if isinstance(types[c], T.IntegralType):
            out[c] = [int(v) for v in out[c]]
        elif isinstance(types[c], T.FractionalType):
            out[c] = [float(v) for v in out[c]]
        elif isinstance(types[c], T.BooleanType):
            out[c] = [v == "true" for v in out[c]]
        out[c] = sorted(out[c])
    return out


def merge_rare(df: DataFrame, cols: Sequence[str] | None = None, threshold: float = 0.01,
               other: str = OTHER) -> DataFrame:
    """Categories with share < threshold become ``OTHER``; null also becomes ``OTHER``."""
    cols = list(cols) if cols is not None else string_columns(df)
    keep = frequent_categories(df, cols, threshold)
    return df.withColumns({c: F.when(qcol(c).isin(keep[c]), qcol(c)).otherwise(F.lit(other))
                           if keep[c] else F.lit(other) for c in cols}) if cols else df


# --------------------------------------------------------------------------- one-hot
def _dummy_name(col: str, value) -> str:
    return f"{col}_{value}"


def onehot_drop_first(df: DataFrame, cols: Sequence[str] | None = None, min_freq: float = 0.01) -> DataFrame:
    """Merge rare, then boolean ``<col>_<value>`` for every sorted value but the first;
    the source column is replaced."""
    cols = list(cols) if cols is not None else string_columns(df)
    keep = frequent_categories(df, cols, min_freq)
    merged = df.withColumns({c: F.when(qcol(c).isin(keep[c]), qcol(c)).otherwise(F.lit(OTHER)) for c in cols})
    has_other = df.agg(*[F.count_if(~F.coalesce(qcol(c).isin(keep[c]), F.lit(False))).alias(c) for c in cols]).first()
    out_cols = []
    for f in merged.columns:
        if f not in cols:
            out_cols.append(qcol(f))
            continue
        values = set(keep[f]) | ({OTHER} if has_other[f] else set())
        for v in sorted(values)[1:]:
            out_cols.append((qcol(f) == F.lit(v)).alias(_dummy_name(f, v)))
    return merged.select(*out_cols)


def onehot_full(df: DataFrame, target: str | None = None, max_categories: int = 1000) -> DataFrame:
    """Dummies for every string column (no rare merge, none dropped), target removed.
    Refuses columns with more than ``max_categories`` values."""
    cols = [c for c in string_columns(df) if c != target]
    if not cols:
        return df.drop(target) if target else df
    nd = df.agg(*[F.count_distinct(qcol(c)).alias(c) for c in cols]).first()
    wide = [c for c in cols if nd[c] > max_categories]
    if wide:
        raise ValueError(f"too many categories for one-hot (> {max_categories}): {wide}")
    values = {c: sorted(r[0] for r in df.where(qcol(c).isNotNull()).select(qcol(c)).distinct().collect())
              for c in cols}
    out = []
    for f in df.columns:
        if f == target:
            continue
        if f in cols:
            out += [F.coalesce(qcol(f) == F.lit(v), F.lit(False)).alias(_dummy_name(f, v)) for v in values[f]]
        else:
            out.append(qcol(f))
    return df.select(*out)


# --------------------------------------------------------------------------- stat encoders
def count_encode(df: DataFrame, cols: Sequence[str] | None = None, min_freq: float = 0.01) -> DataFrame:
    """Category -> its row count after the rare merge (bounded table, broadcast)."""
    cols = list(cols) if cols is not None else string_columns(df)
    out = merge_rare(df, cols, min_freq)
    for c in cols:
        counts = out.groupBy(qcol(c).alias("__k")).agg(F.count(F.lit(1)).alias("__cnt"))
        out = (out.join(F.broadcast(counts), qcol(c) == F.col("__k"), "left")
               .withColumn(c, F.col("__cnt")).drop("__k", "__cnt"))
    return out


def hash_bucket(col: str, n_components: int = 8):
    """md5(value) mod n. The low 32 bits of the digest decide the bucket whenever n divides 2^32."""
    if (1 << 32) % n_components != 0:
        raise ValueError("n_components must divide 2^32")
    return F.conv(F.substring(F.md5(qcol(col).cast("string")), 25, 8), 16, 10).cast("bigint") % F.lit(n_components)


def hash_encode(df: DataFrame, cols: Sequence[str] | None = None, n_components: int = 8,
                min_freq: float = 0.01) -> DataFrame:
    """Per column, indicator columns ``<col>_<i>`` for md5 bucket i; source dropped."""
    cols = list(cols) if cols is not None else string_columns(df)
    merged = merge_rare(df, cols, min_freq)
    out = []
    for f in merged.columns:
        if f in cols:
            b = hash_bucket(f, n_components)
            out += [(b == F.lit(i)).cast("int").alias(f"{f}_{i}") for i in range(n_components)]
        else:
            out.append(qcol(f))
    return merged.select(*out)


def fit_target_stats(df: DataFrame, col: str, target: str) -> DataFrame:
    """(category, n, sum, mean) of the target per non-null category."""
    y = as_double(target)
    return (df.where(qcol(col).isNotNull()).groupBy(qcol(col).alias("__k"))
            .agg(F.count(y).alias("__n"), F.sum(y).alias("__sum"), F.avg(y).alias("__mean")))


def _apply(df: DataFrame, col: str, stats: DataFrame, value, out: str | None) -> DataFrame:
    joined = df.join(stats, qcol(col) == F.col("__k"), "left")
    keep = [qcol(c) for c in df.columns if c != (out or col)]
    return joined.select(*keep, value.alias(out or col))


def mean_encode(df: DataFrame, col: str, target: str, out: str | None = None) -> DataFrame:
    """Category -> plain mean of the target; null category -> null."""
    return _apply(df, col, fit_target_stats(df, col, target), F.col("__mean"), out)


def target_encode(df: DataFrame, col: str, target: str, min_samples_leaf: int = 20, smoothing: float = 10.0,
                  out: str | None = None) -> DataFrame:
    """Smoothed mean: w = 1/(1+exp(-(n-min_leaf)/f)), enc = prior(1-w) + mean w.
    Singletons, null and unseen categories get the prior."""
    prior = df.agg(F.avg(as_double(target))).first()[0]
    n = F.col("__n")
    w = 1.0 / (1.0 + F.exp(-(n - F.lit(min_samples_leaf)) / F.lit(smoothing)))
    blended = F.lit(prior) * (1 - w) + F.col("__mean") * w
    value = F.when(n > 1, blended).otherwise(F.lit(prior))
    return _apply(df, col, fit_target_stats(df, col, target), value, out)


def frequency_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Category -> share of non-null rows; null -> null."""
    counts = df.where(qcol(col).isNotNull()).groupBy(qcol(col).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    total = df.agg(F.count(qcol(col))).first()[0]
    stats = counts.select("__k", (F.col("__n") / F.lit(total)).alias("__share"))
    return _apply(df, col, stats, F.col("__share"), out)


def leave_one_out_encode(df: DataFrame, col: str, target: str, out: str | None = None) -> DataFrame:
    """(sum - y) / (n - 1) within the row's category; singletons, null categories and
    rows with a null target get the global mean."""
    prior = df.agg(F.avg(as_double(target))).first()[0]
    y = as_double(target)
    loo = F.when((F.col("__n") > 1) & y.isNotNull(), (F.col("__sum") - y) / (F.col("__n") - 1))
    return _apply(df, col, fit_target_stats(df, col, target), F.coalesce(loo, F.lit(prior)), out)


def woe_encode(df: DataFrame, col: str, target: str, out: str | None = None) -> DataFrame:
    """ln((events + 0.5) / (non-events + 0.5)) per category for a 0/1 target."""
    value = F.log((F.col("__sum") + 0.5) / (F.col("__n") - F.col("__sum") + 0.5))
    return _apply(df, col, fit_target_stats(df, col, target), value, out)


def cluster_categories(df: DataFrame, col: str, n_clusters: int = 5, seed: int = 42,
                       out: str | None = None, starts: int = 10) -> DataFrame:
    """k-means on the per-category counts, the best of ``starts`` starts; each category becomes ``Cluster_<i>``, numbered by
    rising count. Fitted on the distinct (category, count) table, joined back by category; a null stays null."""
    from .lloyd import kmeans_starts

    counts = (df.where(qcol(col).isNotNull()).groupBy(qcol(col).alias("__k"))
              .agg(F.count(F.lit(1)).cast("double").alias("__cnt"))).persist()
    centres = kmeans_starts(counts, ["__cnt"], [n_clusters], starts, seed)[n_clusters][0].ravel().tolist()
    counts.unpersist()
    apart = F.array(*[F.abs(F.col("__cnt") - F.lit(c)) for c in centres] or [F.lit(0.0)])
    labelled = counts.select("__k", F.concat(F.lit("Cluster_"), F.array_position(apart, F.array_min(apart)) - 1).alias("__lab"))
    return _apply(df, col, labelled, F.col("__lab"), out)


ENCODERS = {
    "onehot": onehot_drop_first,
    "count": count_encode,
    "hash": hash_encode,
    "target": target_encode,
    "mean": mean_encode,
    "frequency": frequency_encode,
    "leave_one_out": leave_one_out_encode,
    "woe": woe_encode,
    "cluster": cluster_categories,
}


def encoding_selected(df: DataFrame, method: str, **kw) -> DataFrame:
    """Dispatch by method name; unknown names are an error."""
    if method not in ENCODERS:
        raise ValueError(f"unknown encoding {method!r}; choose from {sorted(ENCODERS)}")
    return ENCODERS[method](df, **kw)
