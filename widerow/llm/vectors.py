"""Vectors in tasks: Arrow lists as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def matrices(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of a column of lists of numbers, for each length that occurs: the places of its
    rows, and their matrix of doubles. Null rows are left out, null components are NaN."""
    lists = lists.cast(pa.list_(pa.float64()))
    some = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy(zero_copy_only=False)  # nulls become NaN
    starts, sizes = offsets[some], offsets[some + 1] - offsets[some]
    for size in np.unique(sizes):
        at = sizes == size
        yield some[at], values[starts[at][:, None] + np.arange(size)]


def stacked(rows: pa.Array | pa.ChunkedArray, dtype=np.float64) -> np.ndarray:
    """The matrix of binary rows of one length."""
    parts = rows.to_pylist()
    return np.frombuffer(b"".join(parts), dtype).reshape(len(parts), -1)
