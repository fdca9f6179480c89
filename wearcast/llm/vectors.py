"""Vectors in Arrow list columns as numpy matrices."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of doubles that a task unpacks at a time.
CHUNK_BYTES = 4 << 20


def by_length(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of doubles) of the vectors of each length above 0;
    null vectors are left out, null entries become NaN."""
    length = np.asarray(pc.fill_null(pc.list_value_length(col), 0)).astype(np.int64)
    for n in np.unique(length[length > 0]).tolist():
        rows = np.flatnonzero(length == n)
        flat = pc.list_flatten(col.take(pa.array(rows))).cast(pa.float64(), safe=False)
        yield rows, flat.to_numpy(zero_copy_only=False).reshape(len(rows), n)


def pieces(batches: Iterable[pa.RecordBatch], col: str, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with a bounded number of entries each."""
    for b in batches:
        length = np.asarray(pc.fill_null(pc.list_value_length(b.column(col)), 0)).astype(np.int64)
        at = 0
        while at < b.num_rows:
            n = int(np.searchsorted(np.cumsum(length[at : at + rows]) * 8, CHUNK_BYTES, "right"))
            yield b.slice(at, max(1, n))
            at += max(1, n)


def packed(matrix: np.ndarray) -> list[bytes]:
    """Each row's bytes."""
    raw, width = np.ascontiguousarray(matrix).tobytes(), matrix.shape[1] * matrix.itemsize
    return [raw[i : i + width] for i in range(0, len(raw), width)] if width else [b""] * len(matrix)


def unpacked(col: pa.Array, dtype: np.dtype, dim: int) -> np.ndarray:
    """Matrix behind a binary column whose values all hold ``dim`` entries."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not len(col):
        return np.zeros((0, dim), dtype)
    col = col.cast(pa.large_binary())
    first = np.frombuffer(col.buffers()[1], np.int64)[col.offset]
    return np.frombuffer(col.buffers()[2], np.uint8, len(col) * dim * np.dtype(dtype).itemsize, first).view(dtype).reshape(
        len(col), dim)
