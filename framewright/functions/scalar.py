"""Scalar functions (inventory 2.11) as Column expressions: they stay inside
whole-stage codegen, no Python per row."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .stats import as_double, qcol

# Grade bands of the nutrition score (upper bounds, exclusive) and letters.
GRADE_BOUNDS = [(0, "A"), (3, "B"), (11, "C"), (19, "D")]
GRADE_TOP = "E"

# Characters replaced in column names used as file names.
UNSAFE_NAME_CHARS = '\\/*?:"<>|'


def regex_extract(col: str, pattern: str, group: int = 1) -> Column:
    """First match's group, null when there is no match (Spark returns '' then)."""
    return F.nullif(F.regexp_extract(qcol(col), pattern, group), F.lit(""))


def grade_from_score(col: str) -> Column:
    """<0 A, <3 B, <11 C, <19 D, else E; null stays null."""
    x = as_double(col)
    expr = None
    for bound, letter in GRADE_BOUNDS:
        expr = F.when(x < bound, letter) if expr is None else expr.when(x < bound, letter)
    return expr.when(x.isNotNull(), GRADE_TOP)


def tag_prefix_code(col: str) -> Column:
    """Two-letter lower-case prefix before ':' (``fr:...`` -> ``fr``), else null."""
    return F.nullif(F.regexp_extract(qcol(col), r"^([a-z]{2}):", 1), F.lit(""))


def regex_flag(col: str, pattern: str, case_insensitive: bool = True) -> Column:
    """Tri-state contains flag: null stays null."""
    return qcol(col).rlike(f"(?i){pattern}" if case_insensitive else pattern)


def regex_flag_counts(col: str, pattern: str, case_insensitive: bool = True) -> list[Column]:
    """count of true / false / null flags, as three aggregate columns."""
    f = regex_flag(col, pattern, case_insensitive)
    return [F.count_if(f).alias("n_true"), F.count_if(~f).alias("n_false"), F.count_if(f.isNull()).alias("n_null")]


def upper(col: str) -> Column:
    return F.upper(qcol(col))


def lower(col: str) -> Column:
    return F.lower(qcol(col))


def trim(col: str) -> Column:
    return F.trim(qcol(col))


def split(col: str, sep: str = ",") -> Column:
    return F.split(qcol(col), re.escape(sep))


def row_ratio(a: str, b: str) -> Column:
    """a / b per row; null (not an error or inf) when b is 0."""
    return F.try_divide(as_double(a), as_double(b))


def sanitize_column_name(name: str, keep_readable: bool = False) -> str:
    """Replace characters unsafe in file names by '_' (and spaces by '_'); the second
    variant keeps only letters, digits, space, '_' and '-'."""
    if keep_readable:
        return re.sub(r"[^\w \-]", "_", name)
    out = "".join("_" if ch in UNSAFE_NAME_CHARS else ch for ch in name)
    return out.replace(" ", "_")


def sanitize_name_expr(col: str) -> Column:
    """The same rule as :func:`sanitize_column_name`, as a Column expression over text."""
    return F.replace(F.regexp_replace(qcol(col), r'[\\/*?:"<>|]', "_"), F.lit(" "), F.lit("_"))


def sanitize_columns(names: Sequence[str]) -> list[str]:
    return [sanitize_column_name(n) for n in names]
