"""Sums of equally long integer vectors that tasks emit once each.

Tasks that count into a bounded array write it as one row of bytes beside their other
output; ``total`` adds these rows up without passing them through the driver or one
task: partitions merge what they read, blocks of cells are shuffled and added, and
only the finished vector is collected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK_CELLS = 1 << 14


def pack(vector: np.ndarray) -> bytes:
    """Bytes of an integer vector, four a cell where they suffice."""
    small = not len(vector) or max(int(vector.max()), -int(vector.min())) < 2**31
    return vector.astype("<i4" if small else "<i8").tobytes()


def unpack(blob: bytes, size: int) -> np.ndarray:
    return np.frombuffer(blob, "<i4" if len(blob) == 4 * size else "<i8").astype(np.int64)


def total(rows: DataFrame, column: str, size: int) -> np.ndarray:
    """Sum of the packed vectors of ``size`` cells in ``column`` (null: none)."""
    if not size:
        return np.zeros(0, np.int64)
    edges = [(at, min(at + BLOCK_CELLS, size)) for at in range(0, size, BLOCK_CELLS)]

    def merge(batches):
        kept = np.zeros(size, np.int64)
        for batch in batches:
            for blob in batch.column(column).to_pylist():
                kept += unpack(blob, size)
        for k, (a, b) in enumerate(edges):
            if kept[a:b].any():
                yield pa.record_batch([pa.array([k]), pa.array([pack(kept[a:b])], pa.binary())], names=["block", "cells"])

    def add(batches):
        kept = {}
        for batch in batches:
            for k, blob in zip(batch.column("block").to_pylist(), batch.column("cells").to_pylist()):
                a, b = edges[k]
                kept[k] = kept.get(k, 0) + unpack(blob, b - a)
        for k, cells in kept.items():
            yield pa.record_batch([pa.array([k]), pa.array([cells.astype("<i8").tobytes()], pa.binary())], names=["block", "cells"])
    parts = rows.where(f"{column} is not null").select(column).mapInArrow(merge, "block long, cells binary")
    out = np.zeros(size, np.int64)
    for r in parts.repartition("block").mapInArrow(add, "block long, cells binary").collect():
        a, b = edges[r["block"]]
        out[a:b] = np.frombuffer(r["cells"], "<i8")
    return out
