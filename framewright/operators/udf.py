"""Extension surface (inventory 2.16): apply a Python callable to every element.

The reference starts one thread per element; here Spark partitions the rows and a
Pandas UDF receives Arrow batches, so the callable runs in parallel tasks and the
result stays keyed by its row (no order to restore)."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import qcol


def apply_function(df: DataFrame, col: str, func: Callable, return_type: str = "string",
                   out: str = "result", vectorized: bool = False) -> DataFrame:
    """Add ``out`` = func(value) for every row. ``vectorized=True`` passes whole pandas
    Series (the fast path); otherwise the callable is mapped element by element inside
    each Arrow batch."""

    @F.pandas_udf(return_type)
    def _apply(s: pd.Series) -> pd.Series:
        return func(s) if vectorized else s.map(func)

    return df.withColumn(out, _apply(qcol(col)))


def map_partitions_pandas(df: DataFrame, func: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Per-partition pandas transform over Arrow batches (``mapInPandas``)."""

    def _run(batches):
        for pdf in batches:
            yield func(pdf)

    return df.mapInPandas(_run, schema=schema)
