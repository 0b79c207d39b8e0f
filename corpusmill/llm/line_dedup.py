"""Site-relative line dedup, in DataFrame operations only.

Pages are grouped by host. A line's ratio is the number of the host's pages that hold it, over the host's pages; lines
above the boilerplate ratio go from every page of that host. Only 64-bit line hashes are exploded and counted (each once
a page, partly summed before the shuffle), so a line on a third of all pages costs one row for each task. What comes back to the
texts is one array of hashes for each host: a host's mean lines a page over the ratio is the most it can hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import Scratch, blank, read_table

#: A line goes if it is on more than this share of a host's pages, and on MIN_PAGES of them at least.
MAX_RATIO = 0.1
MIN_PAGES = 5
#: Boilerplate hashes up to which the table of hosts is broadcast (16 MB); beyond, it is joined by shuffles.
BROADCAST_LINES = 1_000_000
_EDGE = " \t\r"


def _lines(text: Column) -> Column:
    return F.split(blank(text), "\n", -1)


def _key(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(_EDGE)))


def boilerplate_lines(df: DataFrame, host: Column, text: Column, scratch: Scratch, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line_keys) for each host that has boilerplate; line_keys are hashes of lines without outer blanks."""
    pages = df.select(host.cast("string").alias("host"), text.alias("text"))
    distinct = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), lambda x: F.btrim(x, F.lit(_EDGE)) != ""), _key))
    counts = pages.select("host", F.explode(distinct).alias("line_key")).groupBy("host", "line_key").agg(F.count("*").alias("pages"))
    counts = counts.where(F.col("pages") >= min_pages)
    totals = pages.groupBy("host").agg(F.count("*").alias("host_pages")).withColumnRenamed("host", "total_host")
    found = counts.join(totals, F.col("host").eqNullSafe(F.col("total_host"))).where(F.col("pages") > F.col("host_pages") * F.lit(max_ratio))
    return scratch.save(found.groupBy("host").agg(F.sort_array(F.collect_set("line_key")).alias("line_keys")), "boilerplate", narrow=True)


def dedup_lines(df: DataFrame, host: Column | str = "source", text_col: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """The columns of df with boilerplate lines taken out of text_col, and lines_before and lines_dropped (long).

    Lines end at U+000A and are compared without outer blanks, tabs and carriage returns; blank lines are neither counted
    nor dropped, and the other lines keep their order. Every row is a page, repeated rows too. Null hosts are one host.
    Null and empty texts come back as they are, with lines_before 1 and 0 dropped. Columns of df called lines_before or
    lines_dropped are replaced; other names cannot clash. An empty table stays empty.
    """
    scratch = Scratch(df.sparkSession, "line-dedup")
    host = F.col(host) if isinstance(host, str) else host
    found = boilerplate_lines(df, host, F.col(text_col), scratch, max_ratio, min_pages)
    size = found.agg(F.coalesce(F.sum(F.size("line_keys")), F.lit(0))).first()[0]
    found = F.broadcast(found) if size <= BROADCAST_LINES else found
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), host.cast("string").alias("_host"), F.col(text_col).alias("_text"))
    joined = rows.join(found, F.col("_host").eqNullSafe(F.col("host")), "left")
    lines = _lines(F.col("_text"))
    left = F.filter(lines, lambda x: (F.btrim(x, F.lit(_EDGE)) == "") | ~F.array_contains(F.col("line_keys"), _key(x)))
    joined = joined.withColumn("_kept", F.when(F.col("line_keys").isNotNull(), left)).withColumn("_before", F.size(lines).cast("long"))
    dropped = F.coalesce(F.col("_before") - F.size("_kept"), F.lit(0)).cast("long")
    text = F.when(dropped > 0, F.array_join("_kept", "\n")).otherwise(F.col("_text"))
    own = [c for c in df.columns if c not in ("lines_before", "lines_dropped")]
    return joined.select(*[(text if c == text_col else F.col(f"_row.`{c}`")).alias(c) for c in own], F.col("_before").alias("lines_before"), dropped.alias("lines_dropped"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dedup_lines over all rows and whole texts of documents, a document's source being its host."""
    out = dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc_id", "source", "lines_before", "lines_dropped", F.sha2(blank(F.col("text")), 256).alias("text_sha256"))


OP4_SQL = r"""
WITH pages AS (
  SELECT doc_id, source, coalesce(text, '') AS body, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
found AS (
  SELECT source, list(line) AS gone FROM (
    SELECT source, line, count(*) AS n FROM (
      SELECT DISTINCT doc_id, source, trim(u.line, ' ' || chr(9) || chr(13)) AS line FROM pages, unnest(lines) AS u(line)) AS one
    WHERE line <> '' GROUP BY source, line) AS counts
  JOIN (SELECT source AS s, count(*) AS total FROM pages GROUP BY source) AS totals ON s IS NOT DISTINCT FROM source
  WHERE n >= 5 AND n > total * CAST(0.1 AS DOUBLE) GROUP BY source),
cut AS (
  SELECT doc_id, p.source, lines, list_filter(lines, lambda x: NOT list_contains(coalesce(gone, []), trim(x, ' ' || chr(9) || chr(13)))) AS rest
  FROM pages AS p LEFT JOIN found AS f ON f.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, source, len(lines) AS lines_before, len(lines) - len(rest) AS lines_dropped, sha256(array_to_string(rest, chr(10))) AS text_sha256 FROM cut
"""
