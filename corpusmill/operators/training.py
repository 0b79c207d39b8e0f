"""Splits, upsampling, shuffles and packing: from documents to training rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.config import FormatConfig
from corpusmill.operators.tables import Tables


def document_id(source: Column, key: Column) -> Column:
    return F.concat_ws("/", source.cast("string"), key.cast("string"))


def split_of(doc_id: Column, eval_ratio: float = 0.02) -> Column:
    """'eval' or 'train' by the first 32 bits of the id's md5: stable when documents come or go."""
    fraction = F.conv(F.substring(F.md5(doc_id), 1, 8), 16, 10).cast("double") / F.lit(4294967295.0)
    return F.when(fraction < eval_ratio, "eval").otherwise("train")


def with_split(df: DataFrame, source: str = "source", key: str = "doc_id", config: FormatConfig | None = None) -> DataFrame:
    config = config or FormatConfig()
    return df.withColumn("split", split_of(document_id(F.col(source), F.col(key)), config.eval_ratio))


def weight_of(source: Column, weights: dict[str, int]) -> Column:
    """How often a source's training documents are repeated; 1 for sources without a weight."""
    if not weights:
        return F.lit(1)
    table = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(int(v)))])
    return F.coalesce(F.element_at(table, source), F.lit(1))


def upsample(df: DataFrame, source: str = "source", config: FormatConfig | None = None) -> DataFrame:
    """Training rows as often as their source's weight says, evaluation rows once; copy counts from 1."""
    config = config or FormatConfig()
    times = F.when(F.col("split") == "train", weight_of(F.col(source), config.upsample)).otherwise(1)
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), times)))


def shuffled(df: DataFrame, *keys: str, seed: int = 42) -> DataFrame:
    """A global order by seeded md5 of the keys, the same however the rows are partitioned and in any engine with md5; `place`
    holds what they are ordered by."""
    place = F.md5(F.concat_ws("/", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]))
    return df.withColumn("place", place).orderBy("place", *keys)


def split_stats(df: DataFrame, source: str = "source", config: FormatConfig | None = None) -> DataFrame:
    """raw_docs, train_docs, train_rows, eval_docs and upsample by source; the row without a source holds the totals."""
    config = config or FormatConfig()
    train = F.col("split") == "train"
    weight = weight_of(F.col(source), config.upsample)
    each = df.groupBy(source).agg(F.count("*").alias("raw_docs"), F.count_if(train).alias("train_docs"), F.count_if(~train).alias("eval_docs"))
    each = each.withColumn("upsample", weight).withColumn("train_rows", F.col("train_docs") * F.col("upsample"))
    sums = [F.sum(c).alias(c) for c in ("raw_docs", "train_docs", "train_rows", "eval_docs")]
    return each.select(source, "raw_docs", "train_docs", "train_rows", "eval_docs", "upsample").unionByName(each.agg(*sums).withColumn(source, F.lit(None).cast("string")).withColumn("upsample", F.lit(None).cast("int")))


def chat_text(turns: Column, eos: str = "</s>") -> Column:
    """array<struct<role, content>> in order -> one training text; roles other than user and assistant say nothing."""
    said = F.transform(turns, lambda t: F.when(t.role == "user", F.concat(F.lit("[INST] "), t.content, F.lit(" [/INST]"))).when(t.role == "assistant", F.concat(t.content, F.lit(eos))).otherwise(""))
    return F.array_join(said, "")


def chat_conversations(df: DataFrame, eos: str = "</s>") -> DataFrame:
    """conversations (conv_id, turn, role, text) -> (conv_id, text). A conversation's turns meet in one task; one
    conversation is as long as a person talks."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("content"))))
    return df.groupBy("conv_id").agg(turns.alias("turns")).select("conv_id", chat_text(F.col("turns"), eos).alias("text"))


def answer_of(text: Column) -> Column:
    """What follows the last [/INST], stripped; the whole text without one."""
    return F.regexp_replace(F.substring_index(text, "[/INST]", -1), r"(?U)^\s+|\s+$", "")


def pack_in_order(df: DataFrame, length: str, *order: str, group: str = "source", capacity: int = 2048) -> DataFrame:
    """A running sum of lengths within a group, cut every `capacity` tokens: sequence (from 0) of each row's last token.

    Rows are ranged by group and order and stored; sums run within a range, and what lies before a range is the sum of the
    group's ranges before it. So no task sees a whole group, however large."""
    ranged = df.repartitionByRange(group, *order).withColumn("_part", F.spark_partition_id())
    placed = Tables(df.sparkSession, "pack").save(ranged)
    own = Window.partitionBy("_part", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(group, "_part").agg(F.sum(length).alias("_sum")).withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    sums = sums.select(F.col(group).alias("_group"), F.col("_part").alias("_p"), "_before")  # a few rows for each range
    joined = placed.withColumn("_running", F.sum(length).over(own)).join(sums, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_group")))
    return joined.withColumn("sequence", F.floor((F.col("_before") + F.col("_running") - 1) / capacity)).drop("_part", "_p", "_group", "_before", "_running")


def export_name(title: Column, key: Column) -> Column:
    """A file name: letters, digits, blanks, hyphens and underscores of the title, 80 at most, and the head of the key."""
    safe = F.substring(F.regexp_replace(title, r"[^\p{L}\p{N} _-]", "_"), 1, 80)
    return F.concat(safe, F.lit("_"), F.substring(key.cast("string"), 1, 8), F.lit(".txt"))
