"""Vectors and link matrices in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(column: str) -> Column:
    return F.col(column).cast("array<double>").alias("vector")


def rows_by_length(column: pa.Array):
    """``(positions, matrix)`` for each length of the lists in an Arrow column; only rows that take part.

    Rows that are NULL, empty, zero, or hold a NULL, an infinity or a NaN are left out.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    for length in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == length)
        matrix = flat[starts[at][:, None] + np.arange(length)]
        sound = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
        yield at[sound], matrix[sound] + 0.0


def normalized(matrix: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled first, so that squares neither overflow nor vanish."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def packed(matrix: np.ndarray, kind: str = "float64") -> list[bytes]:
    return [row.tobytes() for row in np.ascontiguousarray(matrix, dtype=kind)]


def unpacked(column: pa.Array, dim: int | None = None) -> np.ndarray:
    """A matrix of doubles from binary rows of one length; with ``dim`` they may be of single precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.to_pylist()
    single = dim is not None and len(values) and len(values[0]) == 4 * dim
    return np.frombuffer(b"".join(values), dtype=np.float32 if single else np.float64).astype(np.float64, copy=False).reshape(len(values), -1)


def spanning(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows and columns of a link matrix the row that stands for their component, -1 without a link."""
    root_a, root_b = np.full(mask.shape[0], -1), np.full(mask.shape[1], -1)
    for start in np.flatnonzero(mask.any(axis=1)):
        if root_a[start] >= 0:
            continue
        rows = np.array([start])
        root_a[start] = start
        while len(rows):
            cols = np.flatnonzero(mask[rows].any(axis=0) & (root_b < 0))
            root_b[cols] = start
            rows = np.flatnonzero(mask[:, cols].any(axis=1) & (root_a < 0)) if len(cols) else cols
            root_a[rows] = start
    return root_a, root_b
