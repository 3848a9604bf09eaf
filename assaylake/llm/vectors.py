"""Vectors of an Arrow batch as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    ok = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce(F.forall(vector, ok), F.lit(False))


def matrix(column: pa.Array, kind, width: int | None = None) -> np.ndarray:
    """One row for each list; shorter lists are followed by zeros. ``width`` is at least that of the longest list."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) if len(column) else np.zeros(0, np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    longest = int(sizes.max(initial=0))
    width = longest if width is None else max(width, longest)
    if len(values) == len(sizes) * width:
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), kind)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def units(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1. No row may be zero; large and small components don't overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))
