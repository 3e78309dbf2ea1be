"""Joins, aggregations, sort / top-k / sampling / set operations (inventory 2.5, 2.6, 2.12).

Category statistics are an aggregate followed by an equi join, never a window over the
category (which would send a hot category to one task). The join is left to AQE: it
sees the aggregate's real size at runtime and broadcasts it when small, otherwise it
keeps a sort-merge join whose skewed partitions it splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import as_double, qcol


# --------------------------------------------------------------------------- joins
def dimension_count_join(dim: DataFrame, facts: DataFrame, dim_key: str, fact_key: str,
                         count_name: str = "n", lower: bool = False) -> DataFrame:
    """Attach per-key fact counts to a dimension table, 0 when absent (left join).

    The fact side is pre-aggregated (partial counts before the shuffle) so a hot key
    costs one row per map task."""
    fk = F.lower(qcol(fact_key)) if lower else qcol(fact_key)
    counts = facts.where(fk.isNotNull()).groupBy(fk.alias("__k")).agg(F.count(F.lit(1)).alias(count_name))
    dk = F.lower(qcol(dim_key)) if lower else qcol(dim_key)
    out = dim.join(counts, dk == F.col("__k"), "left").drop("__k")
    return out.withColumn(count_name, F.coalesce(F.col(count_name), F.lit(0)).cast("bigint"))


def top_category_semi_filter(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """Keep rows whose category is among the k most frequent (ties broken by value).
    The top-k table has k rows, so broadcasting it is bounded."""
    top = top_k_values(df, col, k).select(F.col("value").alias("__v"))
    return df.join(F.broadcast(top), qcol(col) == F.col("__v"), "left_semi")


def category_stat_lookup(df: DataFrame, col: str, stats: dict[str, Column], keep_null_key: bool = False) -> DataFrame:
    """Attach per-category aggregates (e.g. {"mean_y": F.avg("y")}) to every row."""
    agg = df.where(qcol(col).isNotNull()).groupBy(qcol(col).alias("__k")).agg(
        *[e.alias(n) for n, e in stats.items()])
    return df.join(agg, qcol(col) == F.col("__k"), "left").drop("__k")


# --------------------------------------------------------------------------- aggregations
def group_mean(df: DataFrame, by: str, target: str, name: str | None = None) -> DataFrame:
    return df.groupBy(qcol(by)).agg(F.avg(as_double(target)).alias(name or f"mean_{target}"))


def group_sum_count(df: DataFrame, by: str, target: str) -> DataFrame:
    return df.groupBy(qcol(by)).agg(F.sum(qcol(target)).alias("sum"), F.count(qcol(target)).alias("count"))


def cluster_summary(df: DataFrame, cluster: str, features: Sequence[str]) -> DataFrame:
    """Mean, sample std and count of every feature per cluster."""
    exprs = []
    for c in features:
        exprs += [F.avg(as_double(c)).alias(f"{c}_mean"), F.stddev_samp(as_double(c)).alias(f"{c}_std"),
                  F.count(qcol(c)).alias(f"{c}_count")]
    return df.groupBy(qcol(cluster)).agg(*exprs)


def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """(value, count[, share]) over non-null values; share is over the non-null total."""
    counts = df.where(qcol(col).isNotNull()).groupBy(qcol(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    if not normalize:
        return counts
    total = df.agg(F.count(qcol(col))).first()[0]
    return counts.select("value", "count", (F.col("count") / F.lit(total)).alias("share"))


def distinct_count(df: DataFrame, cols: Sequence[str], approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """(column_name, n_distinct, n_unique_with_null): ``nunique`` ignores null, ``len(unique())`` counts it."""
    exprs = []
    for c in cols:
        nd = F.approx_count_distinct(qcol(c), rsd) if approx else F.count_distinct(qcol(c))
        exprs.append(F.struct(nd.alias("n_distinct"),
                              (nd + F.max(qcol(c).isNull().cast("int"))).alias("n_unique_with_null")).alias(c))
    return df.agg(*exprs).unpivot([], list(cols), "column_name", "s").select("column_name", "s.*")


# --------------------------------------------------------------------------- sort / top-k
def sort_desc(df: DataFrame, by: str, tie: str | None = None) -> DataFrame:
    keys = [F.desc(by)] + ([F.asc(tie)] if tie else [])
    return df.orderBy(*keys)


def top_k_values(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """k most frequent values, ties broken by value (TakeOrderedAndProject: each map task
    keeps only k rows)."""
    return (df.where(qcol(col).isNotNull()).groupBy(qcol(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc("value")).limit(k))


def top_k_per_group(df: DataFrame, group: str, order: str, k: int, descending: bool = True,
                    tie: Sequence[str] = ()) -> DataFrame:
    """Top k rows per group. ``row_number() <= k`` lets Spark insert a partial
    WindowGroupLimit before the shuffle, so each map task ships at most k rows per group
    even when one group is hot."""
    o = F.desc(order) if descending else F.asc(order)
    keys = [o] + [F.asc(t) for t in ([tie] if isinstance(tie, str) else tie)]
    w = Window.partitionBy(qcol(group)).orderBy(*keys)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# --------------------------------------------------------------------------- sampling
def hash_unit(key: Column, seed: int = 42) -> Column:
    """Deterministic uniform number in [0, 1) from md5(seed:key); DuckDB computes the same."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def sample_fraction(df: DataFrame, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """Bernoulli sample (size approximately fraction * n)."""
    return df.sample(fraction=fraction, seed=seed)


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42, merge_limit: int = 5_000_000) -> DataFrame:
    """Exactly n rows (or all): the n smallest md5(seed:key), ties broken by key.

    While partitions x n <= ``merge_limit`` this is a TakeOrdered (each task keeps n rows,
    one merge of at most partitions x n). Beyond that the cut is found without a central
    merge: the exact n-th smallest hash is an order statistic (sketch, counts, small
    bracket), rows below it are kept, and only rows sharing the boundary hash are
    ranked by key."""
    u = hash_unit(qcol(key), seed)
    if df.rdd.getNumPartitions() * n <= merge_limit:
        return df.orderBy(u, qcol(key)).limit(n)
    from ..functions.stats import order_statistics

    h = df.withColumn("__u", u)
    total = h.count()
    if n >= total:
        return df
    cut = order_statistics(h, {"__u": [n - 1]}, {"__u": total})[("__u", n - 1)]
    below = h.where(F.col("__u") < F.lit(cut))
    need = n - below.count()
    boundary = h.where(F.col("__u") == F.lit(cut)).orderBy(qcol(key)).limit(need)
    return below.unionByName(boundary).drop("__u")


def sample_stratified(df: DataFrame, stratum: str, fraction: float, key: str, seed: int = 42,
                      accuracy: int = 10_000) -> DataFrame:
    """Same share per stratum: in each stratum the round(fraction * n) rows with the
    smallest md5(seed:key).

    No stratum is sorted whole: stratum sizes and a hash sketch are partial aggregates
    (a hot stratum merges map-side), rows below the sketch bracket are kept outright and
    only the narrow bracket around the cut (about 8/accuracy of the stratum) is ranked.
    A stratum whose bracket misses the cut (sketch error) is ranked in full."""
    cols = [qcol(c) for c in df.columns]
    h = df.withColumn("__u", hash_unit(qcol(key), seed))
    lo_p, hi_p = max(0.0, fraction - 4.0 / accuracy), min(1.0, fraction + 4.0 / accuracy)
    stats = (h.groupBy(qcol(stratum).alias("__s"))
             .agg(F.count(F.lit(1)).alias("__n"), F.percentile_approx("__u", [lo_p, hi_p], accuracy).alias("__b"))
             .withColumn("__m", F.round(F.col("__n") * F.lit(fraction)).cast("bigint")))
    j = h.join(stats, qcol(stratum).eqNullSafe(F.col("__s")))
    lo, hi = F.col("__b")[0], F.col("__b")[1]
    cuts = (j.groupBy(F.col("__s").alias("__s2"), "__b")
            .agg(F.count_if(F.col("__u") < lo).alias("__nb"), F.count_if(F.col("__u") <= hi).alias("__nle"))
            .drop("__b"))
    j = j.join(cuts, F.col("__s").eqNullSafe(F.col("__s2")))
    valid = (F.col("__nb") <= F.col("__m")) & (F.col("__m") <= F.col("__nle"))
    w = Window.partitionBy("__s").orderBy("__u", qcol(key))
    kept_below = j.where(valid & (F.col("__u") < lo))
    bracket = (j.where(valid & (F.col("__u") >= lo) & (F.col("__u") <= hi))
               .withColumn("__r", F.row_number().over(w) + F.col("__nb")).where(F.col("__r") <= F.col("__m")))
    fallback = (j.where(~valid).withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= F.col("__m")))
    return kept_below.select(*cols).unionByName(bracket.select(*cols)).unionByName(fallback.select(*cols))


def hash_split(df: DataFrame, key: str, test_fraction: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Deterministic train / test split by md5(seed:key) (repeatable across engines)."""
    u = hash_unit(qcol(key), seed)
    return df.where(u >= test_fraction), df.where(u < test_fraction)


def hash_split_label(df: DataFrame, key: str, test_fraction: float = 0.2, seed: int = 42,
                     name: str = "split") -> DataFrame:
    """Same split as :func:`hash_split`, as a 'train' / 'test' label column."""
    u = hash_unit(qcol(key), seed)
    return df.withColumn(name, F.when(u < test_fraction, "test").otherwise("train"))


def train_test_split(df: DataFrame, test_fraction: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([1 - test_fraction, test_fraction], seed=seed)
    return train, test


# --------------------------------------------------------------------------- set / shape
def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def stacked_value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Value counts of several columns stacked, in one scan (explode of an array)."""
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), qcol(c).cast("string").alias("value")) for c in cols])
    return (df.select(F.inline(arr)).where(F.col("value").isNotNull())
            .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count")))


def append_columns(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    return df.select("*", *[e.alias(n) for n, e in cols.items()])


def explode_tags(df: DataFrame, col: str, sep: str = ",") -> DataFrame:
    """(tag, count, share): split, trim, one row per tag; share over all input rows.
    Null cells vanish; empty tags are dropped."""
    import re
    tags = (df.select(F.explode(F.split(qcol(col), re.escape(sep))).alias("tag"))
            .select(F.trim("tag").alias("tag")).where(F.col("tag") != ""))
    counts = tags.groupBy("tag").agg(F.count(F.lit(1)).alias("count"))
    total = df.count()
    return counts.select("tag", "count", (F.col("count") / F.lit(total)).alias("share"))


def rare_usage_share(df: DataFrame, col: str, t: int = 3) -> DataFrame:
    """Count of counts: (band, n_values, share) for bands once / 2..t-1 / >= t."""
    counts = df.where(qcol(col).isNotNull()).groupBy(qcol(col)).agg(F.count(F.lit(1)).alias("c"))
    band = F.when(F.col("c") == 1, "once").when(F.col("c") < t, f"2-{t - 1}").otherwise(f">={t}")
    per = counts.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n_values"))
    total = per.agg(F.sum("n_values")).first()[0] or 0
    return per.select("band", "n_values", (F.col("n_values") / F.lit(total)).alias("share"))


def cumulative_sum(df: DataFrame, order: str, value: str, name: str = "cumulative") -> DataFrame:
    """Running sum in ``order``. Meant for small per-component tables (one partition)."""
    w = Window.orderBy(qcol(order)).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(qcol(value)).over(w))
