"""Tables between the steps of a run: they cut lineage, survive lost executors, and keep expressions of one step out of
the next one's filters."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_local_roots: dict[str, str] = {}


class Tables:
    """Writes and rereads tables in the folder of spark.checkpoint.dir, which all executors share."""

    def __init__(self, spark: SparkSession, label: str):
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if root is None:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            application = spark.sparkContext.applicationId
            if application not in _local_roots:
                _local_roots[application] = tempfile.mkdtemp(prefix="corpusmill-")
            root = _local_roots[application]
        self.spark, self.path, self.n = spark, f"{root}/{label}-{uuid.uuid4().hex}", 0

    def folder(self) -> str:
        """A path of its own, for a table that is written part by part."""
        self.n += 1
        return f"{self.path}/{self.n}"

    def save(self, df: DataFrame) -> DataFrame:
        self.n += 1
        df.write.parquet(f"{self.path}/{self.n}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{self.n}")
