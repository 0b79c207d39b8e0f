"""Document store semantics over tables: keys, upserts, resumable downloads and listings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.operators.tables import Tables


def store_key(doc_id: Column) -> Column:
    return F.md5(doc_id.cast("string"))


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key (an upsert): the largest `order` wins. Partly aggregated before its shuffle."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max(F.struct(F.col(order).alias("_o"), *others)).alias("_last")).select(key, *[F.col(f"_last.{c}").alias(c) for c in others])


def union_titles(*listings: DataFrame, title: str = "title") -> DataFrame:
    """Titles of several listings, each once, with the place of its first occurrence: listing number, then order within it."""
    out = None
    for number, part in enumerate(listings):
        rows = part.select(title, F.lit(number).alias("listing"), "ord")
        out = rows if out is None else out.unionByName(rows)
    first = out.groupBy(title).agg(F.min(F.struct("listing", "ord")).alias("first"))
    return first.select(title, "first.listing", "first.ord")


def titles_with_prefix(df: DataFrame, prefixes: list[str], title: str = "title") -> DataFrame:
    """Distinct titles that begin with one of the prefixes."""
    wanted = F.lit(False)
    for p in prefixes:
        wanted = wanted | F.startswith(F.col(title), F.lit(p))
    return df.where(wanted).select(title).distinct()


def pending(wanted: DataFrame, have: DataFrame, key: str) -> DataFrame:
    """Wanted rows that are not there yet."""
    return wanted.join(have.select(key).distinct(), key, "left_anti")


def page_url(base: str, title: Column) -> Column:
    return F.concat(F.lit(base), F.replace(title, F.lit(" "), F.lit("_")))


def long_enough(df: DataFrame, least: int, text_col: str = "text") -> DataFrame:
    """Rows whose text has `least` characters; null and empty texts go."""
    return df.where(F.length(F.coalesce(F.col(text_col), F.lit(""))) >= least)


def fallback_id(prefix: str, *columns: Column) -> Column:
    """prefix and the first value that is neither null nor empty."""
    return F.concat(F.lit(prefix), F.coalesce(*[F.when(c.cast("string") != "", c.cast("string")) for c in columns]))


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """Adds row_index from 0 in the given order, for slices by position. Rows are ranged by key, counted in each range, and
    numbered within it: no task sees all rows. The ranges are stored once, so that their counts and their rows agree."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ranged.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    placed = Tables(df.sparkSession, "numbered").save(placed)
    counts = placed.groupBy("_part").agg((F.max("_at") + 1).alias("_n"))  # one row for each range
    before = counts.select(F.col("_part").alias("_p"), (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return placed.join(F.broadcast(before), F.col("_part") == F.col("_p")).withColumn("row_index", F.col("_before") + F.col("_at")).drop("_part", "_at", "_p", "_before")


def slice_rows(df: DataFrame, start: int, end: int, *order: str) -> DataFrame:
    return numbered(df, *order).where((F.col("row_index") >= start) & (F.col("row_index") < end))


def listed_titles(listing: DataFrame, have: DataFrame | None = None) -> DataFrame:
    """Titles of a listing that was read by ranges: (title, range_no, ord) of each title's first place.

    listing: (range_no, completed, ord, title); range 0 starts at the beginning. It is left out if titles are there already
    (have: ord, title; they come first, as range -1). Ranges count up to the first one that was read to its end.
    """
    rows = listing.select("range_no", "completed", "ord", "title")
    some = have is not None and not have.isEmpty()
    rows = rows.where("range_no > 0") if some else rows
    last = rows.where("completed").agg(F.min("range_no").alias("last")).first()["last"]  # one number
    rows = (rows if last is None else rows.where(F.col("range_no") <= last)).drop("completed")
    if some:
        rows = rows.unionByName(have.select(F.lit(-1).alias("range_no"), "ord", "title"))
    return rows.groupBy("title").agg(F.min(F.struct("range_no", "ord")).alias("first")).select("title", "first.range_no", "first.ord")


def sorted_titles(spark: SparkSession, listings: dict[str, Callable[[], DataFrame]], title: str = "title") -> tuple[DataFrame, dict[str, str]]:
    """Distinct titles of several listings in order, and what went wrong by listing. Each listing is read and stored on its
    own; one that fails is left out."""
    tables, out, failed = Tables(spark, "titles"), None, {}
    for name, read in listings.items():
        try:
            part = tables.save(read().select(F.col(title).alias("title")))
        except Exception as error:  # noqa: BLE001  a listing may fail in any way; the others count
            failed[name] = f"{type(error).__name__}: {error}".splitlines()[0]
            continue
        out = part if out is None else out.unionByName(part)
    out = spark.createDataFrame([], "title string") if out is None else out
    return out.distinct().orderBy("title"), failed
