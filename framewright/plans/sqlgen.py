"""Small helpers to write the DuckDB oracle strings."""

from __future__ import annotations

from collections.abc import Sequence


def union_all(parts: Sequence[str]) -> str:
    return " UNION ALL ".join(f"({p})" for p in parts)


def fences_cte(src: str, col: str, name: str = "f", k: float = 1.5) -> str:
    return (f"{name} AS (SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3, "
            f"quantile_cont({col}, 0.25) - {k} * (quantile_cont({col}, 0.75) - quantile_cont({col}, 0.25)) AS lo, "
            f"quantile_cont({col}, 0.75) + {k} * (quantile_cont({col}, 0.75) - quantile_cont({col}, 0.25)) AS hi "
            f"FROM {src})")


def big(expr: str) -> str:
    """DuckDB sums / counts of integers can be HUGEINT: cast to BIGINT like Spark."""
    return f"CAST({expr} AS BIGINT)"
