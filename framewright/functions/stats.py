"""Statistics helpers shared by the operators.

Everything here is one or a few distributed aggregate jobs returning a handful of
scalars to the driver. Nothing collects a column; of a quantile's bracket at most
``FEW`` values travel.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns (booleans are not numeric)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def datetime_columns(df: DataFrame) -> list[str]:
    kinds = (T.TimestampType, T.TimestampNTZType, T.DateType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def qcol(name: str) -> Column:
    """Column by name, safe for names holding dots or spaces."""
    return F.col(f"`{name}`")


def as_double(name: str) -> Column:
    return qcol(name).cast("double")


def checked_broadcast(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast hint only after counting the (persisted) side: above ``max_rows`` the
    frame is returned unhinted and the planner / AQE pick a shuffle join instead."""
    df = df.persist()
    return F.broadcast(df) if df.count() <= max_rows else df


def one_row(df: DataFrame, exprs: Sequence[Column]) -> dict:
    """Run one global aggregate and return it as a dict (one partial + one final task)."""
    if not exprs:
        return {}
    return df.agg(*exprs).first().asDict()


# ---------------------------------------------------------------------------
# Exact quantiles with linear interpolation (pandas / DuckDB quantile_cont).
#
# Spark's exact ``percentile`` merges a value->count map of every distinct value in
# one final task: unbounded memory at scale. Instead order statistics are selected:
# the first scan takes a count and a sketch that brackets every wanted rank. Then every
# scan settles the brackets that hold few values (exact counts at and below the ends, and the
# values strictly between them, which alone travel) and cuts the others at an even grid
# of sketched quantiles with exact counts, some fiftyfold. A value that many rows share is
# an end of its bracket, so it is counted, never collected. The path is the same at
# every size; a column of 10^12 rows takes four more scans than one of 10^6.
# ---------------------------------------------------------------------------

FEW = 5000          # values a bracket may hold to be settled
HELD = 200_000      # values that one scan may collect, for all columns together
ACCURACY = 20_000   # of the sketches: ranks are off by at most n / ACCURACY
MARGIN = 5          # half the width of a first bracket, in n / ACCURACY
GRID = 200          # cuts of a bracket that holds too many


class _Bracket:
    """Where ranks ``k0`` and ``k1`` (0-based) of a column lie: between values ``lo`` and ``hi`` (None: open), about ``size`` values."""

    def __init__(self, col: str, k0: int, k1: int, size: float, lo=None, hi=None):
        self.col, self.k0, self.k1, self.size, self.lo, self.hi, self.whole, self.slack = col, k0, k1, size, lo, hi, size, 1

    def exprs(self, settle: bool) -> list[Column]:
        """Counts below, at ``lo`` and at ``hi``, and what lies strictly between: all values, or their count and sketched grid."""
        x, lo, hi = as_double(self.col), F.lit(self.lo), F.lit(self.hi)
        inside = x.isNotNull() if self.lo is None else (x > lo) & (x < hi)
        counts = [F.lit(0)] * 3 if self.lo is None else [F.count_if(x < lo), F.count_if(x == lo), F.count_if(x == hi)]
        if settle:
            return [*counts, F.sort_array(F.collect_list(F.when(inside, x)))]
        return [*counts, F.count_if(inside), F.percentile_approx(F.when(inside, x), [i / GRID for i in range(GRID + 1)], ACCURACY)]

    def settled(self, below: int, at_lo: int, at_hi: int, values: list) -> tuple | None:
        """The values of the two ranks, or None if the sketch has missed one of them."""
        if self.lo == self.hi and self.lo is not None:
            at_hi = 0
        out = []
        for k in (self.k0 - below, self.k1 - below):
            if not 0 <= k < at_lo + len(values) + at_hi:
                return None
            out.append(self.lo if k < at_lo else values[k - at_lo] if k < at_lo + len(values) else self.hi)
        return tuple(out)

    def reset(self) -> None:
        self.lo, self.hi, self.size, self.slack = None, None, max(self.whole, FEW + 1), min(2 * self.slack, GRID // 8)

    def cut(self, below: int, at_lo: int, at_hi: int, inside: int, grid: list | None) -> None:
        if self.lo == self.hi and self.lo is not None:
            at_hi = 0
        first, last = self.k0 - below, self.k1 - below
        if not 0 <= first <= last < at_lo + inside + at_hi:
            return self.reset()
        if inside <= FEW:
            self.size = inside
            return
        cells = [max(0, (first - at_lo) * GRID // inside - self.slack), min(GRID, (last - at_lo + 1) * GRID // inside + 1 + self.slack)]
        # a rank among the copies of an end stays there; the other end moves
        lo, hi = self.lo if first < at_lo else grid[cells[0]], self.hi if last >= at_lo + inside else grid[cells[1]]
        if last < at_lo:
            hi = lo
        if first >= at_lo + inside:
            lo = hi
        self.lo, self.hi, self.size = lo, hi, 0 if lo == hi else inside * (cells[1] - cells[0]) / GRID


def _select(df: DataFrame, brackets: list[_Bracket], trace: list | None = None) -> dict:
    """{(column, k0, k1): values of both ranks}. One scan settles or cuts all brackets."""
    out, left = {}, list(brackets)
    while left:
        held, settle = 0, []
        for x in sorted(left, key=lambda x: x.size):
            if x.size <= FEW and held + x.size <= HELD:
                settle.append(x)
                held += x.size
        cut = [x for x in left if x.size > FEW]
        jobs = [(x, x.exprs(True)) for x in settle] + [(x, x.exprs(False)) for x in cut]
        row = df.agg(*[e.alias(f"a{i}_{j}") for i, (_, es) in enumerate(jobs) for j, e in enumerate(es)]).first()
        found = [[row[f"a{i}_{j}"] for j in range(len(es))] for i, (_, es) in enumerate(jobs)]
        if trace is not None:
            trace.append(sum(len(f[3]) for f in found[:len(settle)]))
        for x, f in zip(settle, found, strict=False):
            got = x.settled(*f)
            if got is None:
                x.reset()
            else:
                out[x.col, x.k0, x.k1] = got
                left.remove(x)
        for x, f in zip(cut, found[len(settle):], strict=True):
            x.cut(*f)
    return out


def order_statistics(df: DataFrame, wanted: dict[str, Iterable[int]], counts: dict[str, int] | None = None) -> dict:
    """Exact k-th smallest (0-based, nulls excluded) for each column and rank: ``{(column, k): value}``."""
    if counts is None:
        counts = one_row(df, [F.count(qcol(c)).alias(c) for c in wanted])
    got = _select(df, [_Bracket(c, k, k, counts[c]) for c, ks in wanted.items() for k in sorted(set(ks)) if 0 <= k < counts[c]])
    return {(c, k): v[0] for (c, k, _), v in got.items()}


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], relative_error: float | None = None,
              trace: list | None = None) -> dict[str, list]:
    """Per-column quantiles, nulls ignored. Exact (linear interpolation) unless
    ``relative_error`` is given, in which case ``percentile_approx`` is used. ``trace``
    receives the number of values that each scan after the first has collected."""
    cols, probs = list(dict.fromkeys(cols)), list(probs)
    if not cols:
        return {}
    if relative_error is not None:
        acc = max(1, int(round(1.0 / relative_error)))
        row = one_row(df, [F.percentile_approx(as_double(c), probs, acc).alias(c) for c in cols])
        return {c: list(row[c]) if row[c] is not None else [None] * len(probs) for c in cols}
    delta = MARGIN / ACCURACY
    ends = [min(1.0, max(0.0, p + d)) for p in probs for d in (-delta, delta)]
    row = df.agg(*[F.count(qcol(c)).alias(f"n{i}") for i, c in enumerate(cols)],
                 *[F.percentile_approx(as_double(c), ends, ACCURACY).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    plan, brackets = {}, {}
    for i, c in enumerate(cols):
        n = row[f"n{i}"]
        for j, p in enumerate(probs):
            if not n:
                continue
            h = (n - 1) * p
            k0 = int(math.floor(h))
            plan[c, j] = (k0, min(k0 + 1, n - 1), h - k0)
            bracket = _Bracket(c, *plan[c, j][:2], n)
            if n > FEW:
                (bracket.lo, bracket.hi), bracket.size = row[f"s{i}"][2 * j:2 * j + 2], 2 * (MARGIN + 1) * n / ACCURACY
            brackets[c, k0] = bracket
    got = _select(df, list(brackets.values()), trace)
    out = {}
    for c in cols:
        out[c] = []
        for j in range(len(probs)):
            if (c, j) not in plan:
                out[c].append(None)
                continue
            k0, k1, frac = plan[c, j]
            a, b = got[c, k0, k1]
            out[c].append(a + (b - a) * frac if frac else a)
    return out


def tukey_fences(df: DataFrame, cols: Sequence[str], k: float = 1.5, relative_error: float | None = None) -> dict:
    """{col: (q1, q3, lower, upper)}; None bounds for empty columns."""
    qs = quantiles(df, cols, [0.25, 0.75], relative_error)
    out = {}
    for c in cols:
        q1, q3 = qs[c]
        if q1 is None:
            out[c] = (None, None, None, None)
        else:
            iqr = q3 - q1
            out[c] = (q1, q3, q1 - k * iqr, q3 + k * iqr)
    return out


# ---------------------------------------------------------------------------
# Closed forms over aggregate columns (pure Column arithmetic, stays in codegen)
# ---------------------------------------------------------------------------

def adjusted_skew(g1: Column, n: Column) -> Column:
    """Sample-adjusted skewness G1 (pandas ``skew``) from population g1 (Spark ``skewness``)."""
    n = n.cast("double")
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def adjusted_kurtosis(g2: Column, n: Column) -> Column:
    """Sample-adjusted excess kurtosis G2 (pandas ``kurt``) from population excess g2."""
    n = n.cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def dagostino_k2(g1: float, g2: float, n: int) -> tuple[float, float, float, float]:
    """D'Agostino-Pearson omnibus test from the aggregated population skewness g1,
    excess kurtosis g2 and count n: (skew z, kurtosis z, K2, p-value), p = exp(-K2/2).
    Scalar arithmetic on one aggregated row per column, done on the driver."""
    n = float(n)
    y = g1 * math.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + math.sqrt(2 * (beta2 - 1))
    delta = 1 / math.sqrt(0.5 * math.log(w2))
    alpha = math.sqrt(2 / (w2 - 1))
    y = 1.0 if y == 0 else y
    zs = delta * math.log(y / alpha + math.sqrt((y / alpha) ** 2 + 1))
    e = 3.0 * (n - 1) / (n + 1)
    var = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (g2 + 3 - e) / math.sqrt(var)
    sb1 = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * math.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / sb1 * (2.0 / sb1 + math.sqrt(1 + 4.0 / (sb1 * sb1)))
    denom = 1 + x * math.sqrt(2 / (a - 4.0))
    if denom == 0:
        zk = float("nan")
    else:
        term2 = math.copysign(1.0, denom) * ((1 - 2.0 / a) / abs(denom)) ** (1.0 / 3)
        zk = ((1 - 2 / (9.0 * a)) - term2) / math.sqrt(2 / (9.0 * a))
    k2 = zs * zs + zk * zk
    return zs, zk, k2, math.exp(-k2 / 2)


def safe_corr(a: str, b: str) -> Column:
    """Pairwise-complete Pearson correlation; null (not an error) when a side is constant."""
    x = F.when(qcol(b).isNotNull(), as_double(a))
    y = F.when(qcol(a).isNotNull(), as_double(b))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
