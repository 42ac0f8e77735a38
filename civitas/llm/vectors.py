"""Vectors of an array column as whole-number matrices, and tree-wise sums of task states."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pin

FAN = 16            # states merged by one call
LIMIT = 1 << 40     # whole numbers of a vector lie below it


def finite(vector: Column) -> Column:
    """True for a vector without null, NaN or infinite entries; null for a null vector."""
    return F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))


def matrix(vectors: pa.Array, width: int, scale: int, shift: int = 0) -> np.ndarray:
    """floor(scale * c) + shift for every entry c, as a double, of each vector; shorter vectors end in zero entries."""
    length = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if flat.size and np.abs(flat).max() >= LIMIT:
        raise ValueError(f"an entry times {scale} passes {LIMIT}")
    flat = flat.astype(np.int64) + shift
    if (length == width).all():
        return flat.reshape(-1, width)
    out = np.full((len(length), width), shift, np.int64)
    row = np.repeat(np.arange(len(length)), length)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)] = flat
    return out


def width_of(df: DataFrame, vector: str) -> int:
    return df.agg(F.max(F.size(f"`{vector}`"))).first()[0] or 0


def partition() -> int:
    return TaskContext.get().partitionId()


def state_row(*arrays: np.ndarray) -> pa.RecordBatch:
    """One row (id, state): a task's arrays as bytes, under the number of its partition."""
    return pa.RecordBatch.from_arrays(
        [pa.array([partition()], pa.int64()), pa.array([b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)], pa.binary())],
        names=["id", "state"])


def reduced(states: DataFrame, merge: Callable[[bytes, bytes], bytes], name: str) -> bytes | None:
    """All (id, state) rows merged, in order of id: FAN at a time on the executors, level by level; None without rows.

    Only the last state, whose size does not depend on the input, comes to the driver.
    """
    def merged(key, group):
        rows = sorted(zip(group["id"].to_pylist(), group["state"].to_pylist(), strict=True))
        state = rows[0][1]
        for _, other in rows[1:]:
            state = merge(state, other)
        return pa.table({"id": pa.array([rows[0][0] // FAN], pa.int64()), "state": pa.array([state], pa.binary())})

    while True:
        states = pin(states, name)
        n, top = states.agg(F.count(F.lit(1)), F.max("id")).first()
        if n <= 1:
            return bytes(states.first()["state"]) if n else None
        states = states.groupBy(F.floor(F.col("id") / FAN).alias("g")).applyInArrow(merged, "id long, state binary")
