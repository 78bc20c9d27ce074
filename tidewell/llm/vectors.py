"""Vector columns inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(column: str) -> Column:
    """Neither null nor zero, every component there and finite."""
    c = F.col(column)
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return c.isNotNull() & (F.size(c) > 0) & ~bad & F.exists(c, lambda x: x != 0)


def usual_length(rows: DataFrame, column: str) -> int:
    """The most frequent number of components (the smaller of two as frequent), 0 for an
    empty table: vectors of another length cannot be compared with these."""
    found = rows.groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), "d").first()
    return found["d"] if found else 0


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    n = len(column)
    if not n:
        return np.empty((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) % n or len(set(pa.compute.list_value_length(column).to_pylist())) > 1:
        raise ValueError("vectors differ in length")
    return flat.reshape(n, -1)


def packed(m: np.ndarray) -> list[bytes]:
    return [r.tobytes() for r in np.ascontiguousarray(m)]


def unpacked(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64) if rows else np.empty((0, 0))
