"""Vector columns: which rows hold a usable vector, and vectors as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(vector: Column) -> Column:
    """True for a vector that is not null and holds neither nulls nor components without a finite value."""
    def bad(x: Column) -> Column:
        value = x.cast("double")
        return x.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))

    return vector.isNotNull() & ~F.exists(vector, bad)


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """A list column as rows of doubles; shorter vectors are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes == dim).all():
        return values.reshape(len(sizes), dim)
    rows = np.zeros((len(sizes), dim))
    rows[np.arange(dim) < sizes[:, None]] = values
    return rows
