"""Vectors that can be compared, and their matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def comparable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and all components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of doubles; all lists have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def lengths(column: pa.Array) -> np.ndarray:
    return column.value_lengths().to_numpy(zero_copy_only=False)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by the largest component first, so nothing overflows."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``; equal rows give equal results."""
    return np.einsum("ij,ij->i", unit(a), unit(b))


def matrix_of_keys(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of unsigned 64-bit keys kept as signed numbers; all lists have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return flat.view(np.uint64).reshape(len(column), -1)
