"""Arrow columns and lists as NumPy arrays, for functions that work on batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def numpy(col) -> np.ndarray:
    """A column without nulls."""
    return array(col).to_numpy(zero_copy_only=False)


def array(col) -> pa.Array:
    return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col


def list_lengths(col: pa.Array) -> np.ndarray:
    """List lengths; -1 for a list that is null."""
    return col.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)


def zip_lists(lists: list[pa.Array], lengths: list[np.ndarray]) -> tuple[np.ndarray, list[pa.Array]]:
    """Lists side by side, padded with nulls to the longest of each row: (row lengths, flat columns)."""
    n = np.maximum(np.max(lengths, axis=0), 0)
    row = np.repeat(np.arange(len(n)), n)
    pos = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    out = []
    for col, size in zip(lists, lengths, strict=True):
        own = np.maximum(size, 0)
        values = col.flatten()
        if np.array_equal(own, n):
            out.append(values)
        else:
            out.append(values.take(pa.array((np.cumsum(own) - own)[row] + pos, mask=pos >= own[row])))
    return n, out
