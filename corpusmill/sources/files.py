"""File sources and sinks: JSON document stores, JSON lines, and text exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fields that some stores hold as a list and others as a text.
ANY = T.VariantType()


def _schema(*names: str, **others: T.DataType) -> T.StructType:
    return T.StructType([*(T.StructField(n, T.StringType()) for n in names), *(T.StructField(n, t) for n, t in others.items())])


#: Schemas of raw documents by source.
SCHEMAS = {
    "court": _schema("case_id", "case_num", "case_name", "title", "date", "year", "type", "court", "division", "text", "source", "judgment_id", "case_number", "court_type", "district", "subject", judges=ANY, parties=ANY, lawyers=ANY),
    "kolzchut": _schema("title", "wikitext", "text", "source", "url", categories=ANY),
    "wikisource_laws": _schema("title", "wikitext", "text", "source", "url", categories=ANY),
    "knesset": _schema("law_id", "title", "type", "publication_date", "text", "source", "raw_fields"),
    "clean": _schema("text", "source", "title", "meta"),
}


#: Raw sources that become documents, in order.
RAW_SOURCES = ("court", "kolzchut", "wikisource_laws")


def _is_there(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON document a file; malformed ones are dropped, and so are those with bytes that are no UTF-8 (which Spark
    decodes to U+FFFD). Adds key, the file's name without its ending."""
    raw = spark.read.schema(schema).option("mode", "DROPMALFORMED").option("multiLine", True).json(path, pathGlobFilter="*.json")
    named = raw.withColumn("key", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", ""))
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    damaged = F.concat_ws("", *texts).contains("�")
    return named.where(~damaged)


def read_sources(spark: SparkSession, root: str, sources: list[str], schema: T.StructType | None = None) -> DataFrame:
    """Documents of several source folders, each with its own schema, with source_dir and doc_id (source_dir/key). Folders
    that are not there are left out; one at least must be."""
    there = [s for s in sources if _is_there(spark, f"{root}/{s}")]
    if not there:
        raise FileNotFoundError(f"none of {', '.join(sources)} in {root}")
    out = None
    for source in there:
        part = read_documents(spark, f"{root}/{source}", schema or SCHEMAS[source]).withColumn("source_dir", F.lit(source)).withColumn("doc_id", F.concat_ws("/", F.lit(source), "key"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def write_stage(df: DataFrame, path: str, source: str = "source") -> None:
    """A stage's output, by source. Only the sources at hand are overwritten; the input is never touched."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(source).parquet(path)


def write_training(df: DataFrame, path: str) -> None:
    """train and eval rows as JSON lines with a text each."""
    for split in ("train", "eval"):
        df.where(F.col("split") == split).select("text").write.mode("overwrite").json(f"{path}/{split}")


def read_jsonl(spark: SparkSession, path: str, schema: str = "text string") -> DataFrame:
    return spark.read.schema(schema).json(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_texts(df: DataFrame, path: str, name: str = "file_name", text: str = "text") -> None:
    """One text file for each row, written by the tasks into a folder that all executors reach (any URI that PyArrow's file
    systems know, or a shared path). A task that runs again overwrites its files."""

    def put(rows) -> None:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        system.create_dir(root, recursive=True)
        for row in rows:
            with system.open_output_stream(f"{root}/{row[0]}") as out:
                out.write((row[1] or "").encode("utf-8", "replace"))

    df.select(name, text).foreachPartition(put)
