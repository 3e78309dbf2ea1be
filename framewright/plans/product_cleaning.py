"""The reference notebook's product-table cleaning as one Spark plan.

Ratios are the only fitted values (two aggregate jobs); everything else is row-local,
so the cleaned table is a single projection + filter over the scan, and the
surviving-row count after every filter (the "applied filters" summary) is one
conditional aggregate over the same projection.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import regex_flag
from ..functions.stats import as_double, qcol
from ..operators import clean as C


@dataclass
class ProductRoles:
    """Column roles. The defaults below are the product table's column
    names, patterns, sentinel, cap (900 kcal), missing-count limit (3) and excluded name
    prefixes that the reference notebook uses; they must match for the same result."""
    country: str = "countries"
    country_pattern: str = "(?:France)|(?::fr)"
    sentinel_columns: tuple = ("pnns_groups_1", "pnns_groups_2")
    sentinel: str = "unknown"
    labels: str = "labels"
    organic_pattern: str = "(?:organic)|(?:bio)"
    energy_kj: str = "energy_100g"
    energy_kcal: str = "energy-kcal_100g"
    salt: str = "salt_100g"
    sodium: str = "sodium_100g"
    name: str = "product_name"
    url: str = "url"
    category: str = "main_category"
    tags: str = "categories_tags"
    fiber: str = "fiber_100g"
    energy_cap: float = 900.0
    max_missing: int = 3
    final_columns: tuple = ("url", "product_name", "image_small_url", "main_category", "categories_tags",
                            "organic", "nutrition-score-fr_100g", "saturated-fat_100g", "sugars_100g",
                            "proteins_100g", "fat_100g", "carbohydrates_100g", "salt_100g", "energy-kcal_100g",
                            "fiber_100g")
    sum_excludes: tuple = ("sugars", "saturated", "energy", "nutrition")
    bound_excludes: tuple = ("nutrition", "energy")
    extra: dict = field(default_factory=dict)


def clean_products(df: DataFrame, roles: ProductRoles | None = None) -> tuple[DataFrame, DataFrame]:
    """Returns (cleaned table, funnel of surviving rows per step)."""
    r = roles or ProductRoles()
    t = df.withColumn("__in_country", F.coalesce(regex_flag(r.country, r.country_pattern), F.lit(False)))
    present = [c for c in r.sentinel_columns if c in t.columns]
    t = C.value_to_null(t, present, r.sentinel)
    if r.labels in t.columns:
        t = t.withColumn("organic", regex_flag(r.labels, r.organic_pattern))
    # the two fitted ratios are computed on the in-country rows, as the notebook does
    scope = t.where("__in_country")
    if r.energy_kj in t.columns and r.energy_kcal in t.columns:
        ratio = scope.agg(F.avg(F.try_divide(as_double(r.energy_kj), as_double(r.energy_kcal)))).first()[0]
        if ratio:
            t = t.withColumn(r.energy_kcal, F.coalesce(as_double(r.energy_kcal), as_double(r.energy_kj) / F.lit(ratio)))
    if r.salt in t.columns and r.sodium in t.columns:
        row = scope.agg(F.avg(as_double(r.sodium)).alias("na"), F.avg(as_double(r.salt)).alias("s")).first()
        if row["na"] and row["s"]:
            t = t.withColumn(r.salt, F.coalesce(as_double(r.salt), as_double(r.sodium) / F.lit(row["na"] / row["s"])))
    keep = [c for c in r.final_columns if c in t.columns]
    t = t.select(*[qcol(c) for c in keep], "__in_country")
    if r.energy_kcal in t.columns:
        t = C.threshold_to_null(t, r.energy_kcal, r.energy_cap)
    sum_cols = C.columns_by_regex(t, "_100g", r.sum_excludes)
    t = t.withColumn("__nutrient_sum", C.row_sum(sum_cols))
    bound_cols = C.columns_by_regex(t, "_100g", r.bound_excludes)
    t = C.bounds_to_null_all(t, bound_cols, 0.0, 100.0)
    others = [c for c in keep if c != r.url]
    no_fiber = [c for c in bound_cols if c != r.fiber]
    steps = [
        ("in_country", F.col("__in_country")),
        ("nutrient_sum_0_100", (F.col("__nutrient_sum") >= 0) & (F.col("__nutrient_sum") <= 100)),
        ("not_empty", F.greatest(*[qcol(c).isNotNull() for c in others]) if len(others) > 1
         else qcol(others[0]).isNotNull()),
        ("has_name", qcol(r.name).isNotNull() & ~qcol(r.name).rlike(r"^\s*$") if r.name in t.columns else F.lit(True)),
        ("few_missing", C.row_null_count(no_fiber) < r.max_missing),
        ("has_category", (qcol(r.category).isNotNull() if r.category in t.columns else F.lit(False))
         | (qcol(r.tags).isNotNull() if r.tags in t.columns else F.lit(False))),
    ]
    funnel = C.cleaning_funnel(t, steps)
    cond = F.lit(True)
    for _, pred in steps:
        cond = cond & F.coalesce(pred, F.lit(False))
    cleaned = t.where(cond).drop("__in_country", "__nutrient_sum")
    return cleaned, funnel
