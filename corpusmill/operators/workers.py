"""What bounds the memory of Python workers: batches by bytes and not by rows, and freed memory given back."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import SparkSession

#: Bytes of one Arrow batch between the JVM and Python workers, at most.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches of the session by bytes, unless they are smaller already: texts are long, and rows bound nothing."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name, None)
    if now is None or not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def give_back() -> None:
    """Freed memory of this Python worker goes back to the system: workers outlive their tasks, and allocators keep what was freed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library than glibc
        pass


def joined_batches(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `size` bytes of a string column, whatever the sizes of those that come."""
    held, total = [], 0
    for batch in batches:
        ends = pa.compute.cumulative_sum(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).cast("int64")).to_numpy()
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(ends.searchsorted(before + size - total, "right")))
            held.append(batch.slice(at, to - at))
            total, at = total + int(ends[to - 1]) - before, to
            if total >= size or at < batch.num_rows:
                yield _one(held)
                held, total = [], 0
    if held:
        yield _one(held)


def _one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]
