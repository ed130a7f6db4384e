"""Rows of fixed-width numbers that are grouped by a 64-bit key, carried through a shuffle as packed arrays.

A task gathers many rows, reduces them by key, and sends one binary per bucket
of keys instead of one row per key, so the engine moves and sorts a few large
rows. Buckets are ranges of the key's hash; their number follows the rows, so
that one of them fits easily in memory whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "bucket int, packed binary"
#: Rows that a task gathers before it sends them, and rows of a bucket on average.
FLUSH, BUCKET_ROWS = 1 << 19, 1 << 19


def buckets_for(rows: float) -> int:
    return int(min(max(rows // BUCKET_ROWS, 1), 1 << 30))


class Gathered:
    """Columns of equal length, the first of them the keys (uint64), gathered up to FLUSH rows."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.rows = 0

    def add(self, *columns: np.ndarray) -> bool:
        """Whether it is full."""
        if len(columns[0]):
            self.parts.append(columns)
            self.rows += len(columns[0])
        return self.rows >= FLUSH

    def take(self) -> list[np.ndarray]:
        """All columns in the order of the keys."""
        columns = [np.concatenate(x) for x in zip(*self.parts, strict=True)]
        self.parts, self.rows = [], 0
        order = np.argsort(columns[0], kind="stable")
        return [x[order] for x in columns]


def scatter(buckets: int, direct: bool, *columns: np.ndarray) -> pa.RecordBatch:
    """One binary per bucket of rows in the order of their keys; ``direct`` ones are only carried (their bucket is negative)."""
    key = columns[0]
    at = (((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
    start = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(key) else np.zeros(0, np.int64)
    edge = np.append(start, len(key)).tolist()
    packed = [b"".join([x[i:j].tobytes() for x in columns]) for i, j in zip(edge[:-1], edge[1:], strict=True)]
    name = at[start].astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(~name if direct else name, pa.int32()), pa.array(packed, pa.binary())], ["bucket", "packed"])


def unpack(packed: list[bytes], kinds: list) -> list[np.ndarray]:
    """The columns of all rows in some binaries."""
    width = sum(np.dtype(k).itemsize for k in kinds)
    out: list[list[np.ndarray]] = [[] for _ in kinds]
    for x in packed:
        n, at = len(x) // width, 0
        for column, k in zip(out, kinds, strict=True):
            column.append(np.frombuffer(x, k, n, at))
            at += n * np.dtype(k).itemsize
    return [np.concatenate(c) if c else np.zeros(0, k) for c, k in zip(out, kinds, strict=True)]


def shuffled(rows: DataFrame) -> DataFrame:
    """Rows of SCHEMA by bucket, one bucket after the other in each partition."""
    return rows.repartition("bucket").sortWithinPartitions("bucket")


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Each bucket with its binaries; direct ones (negative) as they come, a batch at a time."""
    name, held = None, []
    for b in batches:
        for bucket, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if bucket < 0:
                yield bucket, [packed]
                continue
            if bucket != name and held:
                yield name, held
                held = []
            name = bucket
            held.append(packed)
    if held:
        yield name, held
