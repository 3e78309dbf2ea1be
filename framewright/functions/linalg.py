"""Sums of small matrices that every partition contributes to."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summed_arrays(df: DataFrame, keys: Sequence[str], col: str, fan: int = 64) -> DataFrame:
    """Element-wise sum of an array<double> column by ``keys``, in two steps: ``fan`` sums a key, then their sum."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}

    def step(rows: DataFrame, by: list[str]) -> DataFrame:
        def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame([[*key, np.sum(np.stack(pdf[col].to_numpy()), axis=0)]], columns=[*by, col])
        return rows.groupBy(*by).applyInPandas(add, ", ".join([*(f"`{k}` {types.get(k, 'int')}" for k in by), f"`{col}` array<double>"]))

    keys = list(keys)
    return step(step(df.withColumn("__fan", F.pmod(F.spark_partition_id(), F.lit(fan))), [*keys, "__fan"]).drop("__fan"), keys)
