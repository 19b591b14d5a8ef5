"""Vectors in Arrow batches as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A column of number arrays as ``(good, start, end, flat)``: row i is ``flat[start[i]:end[i]]``, as doubles. A row is
    good if it has entries, and none of them is null, infinite or not a number."""
    length = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null becomes not-a-number
    end = np.cumsum(length)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    return (length > 0) & (bad[end] == bad[end - length]), end - length, end, flat


def matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """A column of binary values, each ``width`` numbers of a numpy ``kind``, as a matrix on Arrow's own memory."""
    if not len(column):
        return np.empty((0, width), kind)
    _, offsets, data = column.buffers()
    first, last = np.frombuffer(offsets, np.int32)[[column.offset, column.offset + len(column)]]
    return np.frombuffer(data, kind, (last - first) // np.dtype(kind).itemsize, first).reshape(-1, width)
