"""Vector columns as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dimension(df: DataFrame, column: str) -> int:
    """The largest number of components of a list column (0 if there is none)."""
    return max(df.agg(F.max(F.size(column))).first()[0] or 0, 0)


def matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Doubles of a list column, a row each, shorter ones padded with zeros, and which rows are whole.

    A row is whole if it is not null and holds no null or non-finite component.
    """
    n = len(column)
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64())
    values = (values.fill_null(np.nan) if values.null_count else values).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(n), sizes)
    out = np.zeros((n, dim))
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    whole = column.is_valid().to_numpy(zero_copy_only=False) & np.isfinite(out).all(axis=1)
    return out, whole
