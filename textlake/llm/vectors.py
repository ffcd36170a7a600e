"""Vector tables as the two search operators read them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id, v``: one row per key, components as doubles, negative zero as zero.

    Left out are rows without key, null vectors, and vectors that hold null or non-finite
    components. Of several vectors with the same key the smallest, compared by components, takes
    part.
    """
    value = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double") + F.lit(0.0))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = df.select(F.col(f"`{key}`").cast("long").alias("vec_id"), value.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(~odd)
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def is_query(key: Column, every: int = 20) -> Column:
    return key % every == 0


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """A column of equally long lists as a matrix, one row each."""
    rows = len(column)
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, -1) if rows else flat.reshape(0, 0)
