"""Shuffles of packed arrays: a row carries many 64-bit keys as bytes, so that billions of keys are few rows.

A task deals its keys out to buckets by their hash and sends one row per bucket and batch. Buckets are many more than the
keys' hot values matter to: each task sends a key once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def dealt(bucket: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts the entries of each bucket together, stable within it, and where each bucket starts."""
    order = np.argsort(bucket.astype(np.uint16 if n <= 1 << 16 else np.int64), kind="stable")
    return order, np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=n))])


def rows_of(column, dtype) -> list[np.ndarray]:
    """The arrays that a binary column carries."""
    return [np.frombuffer(x.as_buffer(), dtype) if x.is_valid else np.zeros(0, dtype) for chunk in column.chunks for x in chunk]


def joined(column, dtype) -> np.ndarray:
    parts = rows_of(column, dtype)
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def by_bucket(name: str, begins: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """One row per bucket that has entries, with each column's entries as bytes."""
    full = np.flatnonzero(np.diff(begins))
    arrays = [pa.array([x[begins[i] : begins[i + 1]].tobytes() for i in full], pa.binary()) for x in columns.values()]
    return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *arrays], [name, *columns])
