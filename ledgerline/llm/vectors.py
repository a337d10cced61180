"""Columns of vectors as arrays, for the operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def sound(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of a list column the length of each vector, -1 where it is null or holds null or non-finite components, and
    the components of all lists, one after the other, as doubles."""
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    ends = np.cumsum(size)
    broken = (bad[ends] > bad[ends - size]) | ~column.is_valid().to_numpy(zero_copy_only=False)
    return np.where(broken, -1, size), flat


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and components, as a matrix of doubles, of the sound vectors of each length above 0."""
    size, flat = sound(column)
    starts = np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    for n in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == n)
        yield rows, flat[(starts[rows] - n)[:, None] + np.arange(n)]


def integers(column: pa.Array, dim: int, scale: int, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the sound vectors of ``dim`` components, none beyond ``most`` in size, and floor(scale * x) of each component."""
    for rows, x in by_length(column):
        if x.shape[1] == dim:
            near = (np.abs(x) <= most).all(axis=1)
            return rows[near], np.floor(scale * x[near]).astype(np.int64)
    return np.zeros(0, np.int64), np.zeros((0, dim), np.int64)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A column of whole vectors of one length, as a matrix of 64-bit integers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def lists(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The rows of a matrix as a list column."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), kind))
