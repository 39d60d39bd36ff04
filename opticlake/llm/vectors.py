"""Rows of vector columns as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column of equal lengths without NULL as rows of doubles."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def finite_vectors(vectors: DataFrame, number: str, vector: str, largest: float, *more) -> DataFrame:
    """Rows (number, vector, ...) whose vector has components, all of them known and of a size below `largest`."""
    held = vectors.select(F.col(number).cast("long").alias("number"), F.col(vector).alias("vector"), *more)
    small = F.forall("vector", lambda x: F.coalesce(F.abs(x.cast("double")) < largest, F.lit(False)))
    return held.where((F.size("vector") > 0) & small)
