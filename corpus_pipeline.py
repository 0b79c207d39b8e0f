"""A training-data pipeline over documents: each stage calls one operator of corpusmill.llm.

Stages take (spark, docs, sf_dir) and return a DataFrame; its rows are written as Parquet and reread as the next stage's
docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import line_dedup, mixing, near_dedup, packing, quality
from corpusmill.llm.common import Scratch, read_table

#: Documents below this score are rejected. Lower than the threshold of the classifier's own verdict: clean documents stay.
REJECT_BELOW = 0.5


def _recounted(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, n_chars counted anew where a stage has changed texts."""
    return rows.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; the classifier is fitted on labelled documents of this input.

    Null and empty texts are scored by the bias alone. Without labels no document is rejected. Rows that repeat an id or a
    text are scored like others; ties cannot matter. An empty table stays empty. Columns keep any names."""
    weights = quality.train(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text"), weights)
    return scored.where(F.col("score") >= REJECT_BELOW).select("row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are boilerplate of their source go from its documents.

    Null texts stay null, empty ones empty, and no document goes. A null source is a host of its own. Repeated rows count
    as pages of their host. A line on just the ratio of pages stays. An empty table stays empty."""
    return _recounted(line_dedup.dedup_lines(docs, "source"), docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) the document with the smallest doc_id stays.

    Null and empty texts and null ids are in no group and stay. Rows that repeat a doc_id stay or go together. An empty
    table stays empty. Columns keep any names."""
    gone = near_dedup.near_dedup(docs).where(~F.col("kept")).select("doc_id").distinct()
    rows = docs.select("doc_id", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(gone, "doc_id", "left_anti").select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; those it doesn't take go, null and empty texts among them.

    A null source is a source of its own, last in order. Repeated rows are rows like others, and those with equal id and
    text are exchangeable. An empty table stays empty."""
    return _recounted(mixing.mixed_texts(docs), docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences. Null and empty texts are one piece of id 0 alone;
    repeated rows are packed as often as they occur; an empty table gives no rows; no column but doc_id is returned."""
    return packing.pack_documents(docs, packing.default_tokenizer())


STAGES = [("quality", quality_stage), ("line dedup", line_stage), ("near dedup", near_stage), ("mixing", mixing_stage), ("packing", packing_stage)]

#: SQL can express none of the stages but line dedup (see tests/llm for brute-force versions).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents; the rows of the last."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
