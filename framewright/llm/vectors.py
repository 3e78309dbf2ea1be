"""Vector columns inside tasks: decoding and validity."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def decode(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(valid, doubles): rows that hold ``width`` finite components, not all zero. Others are zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out, ok = np.zeros((len(column), width)), np.zeros(len(column), dtype=bool)
    sizes = np.array(column.value_lengths().fill_null(-1))
    fit = np.flatnonzero(sizes == width)
    if width and len(fit):
        flat = column.take(pa.array(fit)).flatten()
        x = np.array(flat.cast(pa.float64()).fill_null(float("nan"))).reshape(-1, width)
        good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
        out[fit[good]], ok[fit[good]] = x[good], True
    return ok, out


def width_of(df: DataFrame, vec: str) -> int:
    """The commonest vector length, the smaller of ties; 0 for a table without vectors."""
    row = df.where(F.size(vec) > 0).groupBy(F.size(vec).alias("w")).count().orderBy(F.desc("count"), "w").first()
    return row["w"] if row else 0


def sample_of(df: DataFrame, id_col: str, vec: str, n: int, width: int) -> np.ndarray:
    """At most ``n`` valid vectors, those of the smallest id hash: bounded and repeatable."""
    got = df.where(F.size(vec) == width).orderBy(F.xxhash64(id_col), id_col).limit(n).select(vec).toArrow()
    ok, x = decode(got.column(0), width)
    return x[ok]
