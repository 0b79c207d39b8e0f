"""Incremental ingest with Structured Streaming: file streams, exact dedup within a watermark, and batch upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.columns import text_or_empty
from corpusmill.operators.dedup import normalised


def document_stream(spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int = 100, file_format: str = "parquet") -> DataFrame:
    """New files of a folder as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(file_format).load(path)


def dedup_stream(stream: DataFrame, time_col: str, late: str = "1 day", source: str = "source", text_col: str = "text") -> DataFrame:
    """The first document of each source and normalised text within the watermark. State is one hash for each text and is
    dropped when the watermark passes it."""
    hashed = stream.withColumn("text_hash", F.sha2(normalised(text_or_empty(text_col)), 256))
    return hashed.withWatermark(time_col, late).dropDuplicatesWithinWatermark([source, "text_hash"])


def windowed_counts(stream: DataFrame, time_col: str, width: str = "1 hour", late: str = "10 minutes", *keys: str) -> DataFrame:
    """Rows by tumbling window and keys."""
    return stream.withWatermark(time_col, late).groupBy(F.window(time_col, width), *keys).agg(F.count("*").alias("documents"))


def append_batches(stream: DataFrame, path: str, checkpoint: str, **trigger):
    """A query that writes each batch to a folder named by its number: a batch that is run again overwrites itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
