"""Whole-number vectors of Arrow list columns.

A vector takes part if neither it nor any component is null and all components are finite. A component x becomes
floor(256 * x), x as double; numbers beyond the bound of a job, where its results no longer fit 64 bits, count as the bound. A
vector shorter than the longest that takes part counts with zeros behind it.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
#: Numbers that a task turns into a matrix at a time.
VALUES = 1 << 21


def usable(vector: str) -> Column:
    """Whether a vector takes part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.col(vector).isNotNull() & ~bad


def width(rows: DataFrame, vector: str) -> int:
    """Components of the longest vector (0 without rows)."""
    return rows.agg(F.max(F.size(vector))).first()[0] or 0


def bound(dim: int, times: int = 1) -> int:
    """The largest number for which ``times`` a sum of ``dim`` products fits 64 bits."""
    return isqrt((2**63 - 1) // (max(dim, 1) * times))


def matrix(column: pa.Array, dim: int, most: int) -> np.ndarray:
    """The components of all rows, a row a vector, as 64-bit integers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offs = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.slice(int(offs[0]), int(offs[-1] - offs[0])).to_numpy(zero_copy_only=False).astype(np.float64)
    flat = np.clip(np.floor(flat * SCALE), -most, most).astype(np.int64)
    size = np.diff(offs)
    if (size == dim).all():
        return flat.reshape(len(size), dim)
    out = np.zeros((len(size), dim), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(offs[:-1] - offs[0], size)] = flat
    return out


def slices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``VALUES`` components (one row at least)."""
    step = max(1, VALUES // max(dim, 1))
    for b in batches:
        for i in range(0, b.num_rows, step):
            yield b.slice(i, step)


def packed(values: np.ndarray, kind: str) -> pa.Array:
    """A binary column: each row's numbers as little-endian ``kind``."""
    data = np.ascontiguousarray(values, kind)
    offs = np.arange(len(data) + 1, dtype=np.int32) * (data.itemsize * (data.shape[1] if data.ndim > 1 else 1))
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offs), pa.py_buffer(data)])


def unpacked(column: pa.Array, kind: str, n: int) -> np.ndarray:
    """The numbers of a column made by ``packed``, n a row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column) or not n:
        return np.zeros((len(column), n), kind)
    at = int(np.frombuffer(column.buffers()[1], np.int32, 1, 4 * column.offset)[0])
    return np.frombuffer(column.buffers()[2], kind, len(column) * n, at).reshape(-1, n)
