"""What the training-data operators share: scratch tables in the cluster's shared folder, and small column helpers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the data contracts: U+0020 and U+0009 to U+000D, nothing else.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r" \t-\r"
WORD_PATTERN = rf"[^{SPACE_CLASS}]+"


_local_roots: dict[str, str] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The folder that all executors share. It is the session's spark.checkpoint.dir; only a local master may go without one."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="corpusmill-")
    return _local_roots[application]


#: Bytes of one Arrow batch between the JVM and Python workers, at most.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes: texts are long, and the default of so many rows a batch bounds nothing.

    This sets spark.sql.execution.arrow.maxBytesPerBatch of the session, unless it is smaller already."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name, None)
    if now is None or not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def give_back() -> None:
    """Freed memory of this Python worker goes back to the system. Workers outlive their tasks and share an executor's memory
    limit with its JVM, and both allocators keep what was freed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library than glibc
        pass


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run over the batches of a task, and then give_back."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


#: Files of a scratch table for each core of the cluster, at most: of wide tables, and of narrow ones (a few numbers a row).
WIDE_FILES, NARROW_FILES = 8, 2


class Scratch:
    """Tables written to the shared folder: they cut lineage, survive lost executors, and can be dropped once read.

    Small files cost more than their bytes (a local Hadoop file system even starts three processes for each), so a table's
    files follow the cores that write it and not the partitions of what it came from."""

    def __init__(self, spark: SparkSession, label: str):
        bound_batches(spark)
        self.spark = spark
        self.root = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
        self.count = 0

    def save(self, df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
        """The same rows, reread from a Parquet table that nothing recomputes."""
        self.count += 1
        path = f"{self.root}/{self.count:04d}-{name}"
        df.coalesce((NARROW_FILES if narrow else WIDE_FILES) * self.spark.sparkContext.defaultParallelism).write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later plan reads."""
        jvm = self.spark.sparkContext._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def blank(column: Column) -> Column:
    """Null texts count as empty."""
    return F.coalesce(column.cast("string"), F.lit(""))


def power_of_two(at_least: float) -> int:
    """The smallest power of two that is not below the argument (1 at least)."""
    n = 1
    while n < at_least:
        n *= 2
    return n
