"""Vectors out of Arrow list columns, and integer vectors packed into binary values."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Vector components handled at once inside a task.
PIECE_VALUES = 1 << 20


def pieces(batches, column, limit=PIECE_VALUES):
    """Runs of whole rows whose vectors hold at most ``limit`` components, or one longer row."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        ends = np.cumsum(pc.list_value_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(ends):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def matrices(lists):
    """``(rows, matrix)`` per vector length: the vectors of whole, finite, non-empty lists as doubles.

    NULL lists, empty ones and those with a NULL or non-finite component are left out.
    """
    lengths = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # NULL reads as NaN
    ends = np.cumsum(lengths)
    for size in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == size)
        if len(rows) * size == len(flat):
            matrix = flat.reshape(-1, size)
        else:
            matrix = flat[(ends[rows] - size)[:, None] + np.arange(size)]
        whole = np.isfinite(matrix).all(axis=1)
        yield rows[whole], matrix[whole]


def floored(matrix, scale, limit):
    """``floor(scale * c)`` as whole numbers, and which rows stay within ``±limit``."""
    scaled = np.floor(matrix * float(scale))
    fits = (np.abs(scaled) <= limit).all(axis=1)
    return scaled[fits].astype(np.int64), fits


def binary(matrix):
    """One binary value per row of an integer matrix."""
    data = np.ascontiguousarray(matrix)
    width = data.shape[1] * data.itemsize
    offsets = np.arange(len(data) + 1, dtype=np.int64) * width
    return pa.Array.from_buffers(pa.large_binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.binary())


def packed(matrix):
    """``(rows, width, binary)`` of an integer matrix, rows by the fewest bytes a component needs.

    The width follows from the vector alone, so equal vectors have equal bytes.
    """
    narrow = (np.abs(matrix) < 1 << 15).all(axis=1)
    for rows, kind in ((np.flatnonzero(narrow), "<i2"), (np.flatnonzero(~narrow), "<i4")):
        if len(rows):
            yield rows, int(kind[-1]), binary(matrix[rows].astype(kind))


def unpacked(data, width, dims):
    """The integer matrix of a binary value that holds vectors one after the other."""
    return np.frombuffer(data, f"<i{width}").reshape(-1, dims).astype(np.int64)
