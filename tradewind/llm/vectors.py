"""Vectors of a table, made sound: what the vector operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sound(embeddings: DataFrame, *more: str) -> DataFrame:
    """vec_id, x (array of double) and norm of the rows that take part, with columns ``more``.

    Rows whose id or vector is null, and vectors that are empty, zero or hold null or non-finite
    components, take no part.
    """
    x = F.transform("embedding", lambda v: v.cast("double"))
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    square = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
    return (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"), *more)
        .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
        .where(~bad)
        .withColumn("norm", F.sqrt(square))
        .where("norm > 0")
    )


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow column of equally long lists."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))
