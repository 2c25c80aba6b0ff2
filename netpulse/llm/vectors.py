"""Vectors of a table as matrices, inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def matrices(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of doubles) for each length, of the vectors that are present and wholly finite."""
    offsets = column.offsets.to_numpy()
    lengths = np.diff(offsets)
    flat = pc.fill_null(column.values.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    present = ~column.is_null().to_numpy(zero_copy_only=False)
    for length in np.unique(lengths[present]):
        rows = np.flatnonzero(present & (lengths == length))
        matrix = flat[offsets[rows][:, None] + np.arange(length)]
        good = np.isfinite(matrix).all(axis=1)
        yield rows[good], matrix[good]


def binary(rows: np.ndarray) -> pa.Array:
    """One binary value per row of a matrix."""
    rows = np.ascontiguousarray(rows)
    n, size = len(rows), rows.dtype.itemsize * rows.shape[1]
    if n * size >= 2**31:
        return pa.chunked_array([binary(part) for part in np.array_split(rows, 2)]).combine_chunks()
    ends = np.arange(n + 1, dtype=np.int64) * size
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(rows.tobytes())])


def matrix_of(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """The matrix that ``binary`` made a column of, ``width`` values of type ``kind`` a row."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, dtype=kind).reshape(-1, width)
