"""Arrow <-> numpy helpers for operators that need whole ordered groups.

The partitions handed to these helpers are clustered and sorted by a group key
(a Window upstream does both), so a group is a contiguous range of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def matrix(column: pa.Array | pa.ChunkedArray, width: int, strict: bool = False) -> np.ndarray:
    """A list column as an (n, width) float64 matrix: null lists, null elements and missing tails are NaN.  Of longer lists
    only the first ``width`` elements are channels; with ``strict`` they are an error."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    out = np.full((n, width), np.nan)
    if n == 0:
        return out
    flat = column.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == width).all():
        return values.reshape(n, width).copy()
    if strict and (lengths > width).any():
        raise ValueError(f"a list of {int(lengths.max())} numbers where {width} are declared")
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    pos = np.arange(width)
    have = pos[None, :] < lengths[:, None]
    out[have] = values[(starts[:, None] + pos)[have]]
    return out


def whole_groups(batches: Iterator[pa.RecordBatch], key: str | list[str], rows: int = 20_000) -> Iterator[pa.Table]:
    """Regroups sorted record batches into tables of at least ``rows`` rows that never split a group of equal ``key``."""
    keys = [key] if isinstance(key, str) else key
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        table = pa.Table.from_batches(held)
        changed = np.zeros(table.num_rows, bool)
        for k in keys:
            v = table.column(k).combine_chunks()
            x = v.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            changed[1:] |= x[1:] != x[:-1]
        at = np.flatnonzero(changed)
        if len(at) == 0:
            continue
        cut = int(at[-1])
        yield table.slice(0, cut)
        rest = table.slice(cut)
        held, n = rest.to_batches(), rest.num_rows
    if held:
        yield pa.Table.from_batches(held)


def starts_of(*keys: np.ndarray) -> np.ndarray:
    """Positions where any of the sorted key columns changes; the first row counts."""
    n = len(keys[0])
    changed = np.ones(n, bool)
    if n:
        changed[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(changed)


def longs(table: pa.Table, name: str) -> np.ndarray:
    """An integer column as int64; nulls become the smallest value."""
    return table.column(name).combine_chunks().cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return edge[::2], edge[1::2]
