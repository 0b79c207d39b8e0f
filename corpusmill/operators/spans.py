"""Entity spans: BIO decoding, token windows, merging and replacement. NER models plug in as Arrow-batched scorers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.config import NAME_PLACEHOLDER
from corpusmill.functions.columns import in_chunks, let
from corpusmill.functions.scrub import scrub
from corpusmill.operators.store import slice_rows

WINDOW, STEP = 510, 110
SPANS = "array<struct<s:int,e:int>>"


def decode_bio(tokens: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, idx, start, end, label) -> (doc, s, e): person spans.

    B opens a span and closes the one before; I goes on with an open span; anything else, and special tokens with offsets
    (0, 0), close it. Spans are islands: a running count of openings and breaks groups a B with the I that follow it.
    """
    special = (F.col("start") == 0) & (F.col("end") == 0)
    begins = ~special & F.col("label").isin("B-PER", "B-PERSON")
    inside = ~special & F.col("label").isin("I-PER", "I-PERSON")
    marked = tokens.withColumn("_begins", begins).withColumn("_inside", inside).withColumn("_island", F.sum(F.when(inside, 0).otherwise(1)).over(Window.partitionBy(doc).orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)))
    spans = marked.where("_begins OR _inside").groupBy(doc, "_island").agg(F.max("_begins").alias("_opened"), F.min_by("start", "idx").alias("s"), F.max_by("end", "idx").alias("e"))
    return spans.where("_opened").select(doc, F.col("s").cast("int").alias("s"), F.col("e").cast("int").alias("e"))


def window_starts(total: Column, size: int = WINDOW, step: int = STEP) -> Column:
    """Starts of overlapping token windows: 0, step, ... up to the first window that reaches the end; none without tokens."""
    last = F.ceil(F.greatest(total - size, F.lit(0)) / step).cast("int")
    return F.when(total > 0, F.transform(F.sequence(F.lit(0), last), lambda k: k * step)).otherwise(F.array().cast("array<int>"))


def token_windows(df: DataFrame, total: str, size: int = WINDOW, step: int = STEP) -> DataFrame:
    """Rows with one window each: window_start and window_end (exclusive)."""
    return df.withColumn("window_start", F.explode(window_starts(F.col(total), size, step))).withColumn("window_end", F.least(F.col("window_start") + size, F.col(total)).cast("int"))


def merge_spans(spans: Column) -> Column:
    """Distinct spans in order, merged where one starts no later than the one before ends (touching spans merge). Spans are
    merged within chunks, then chunk by chunk: a chunk's leading spans may fall into the last one of the chunks before."""
    none = F.array().cast(SPANS)
    span = lambda s, e: F.array(F.struct(s.alias("s"), e.alias("e")))
    but_last = lambda out: F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0)))

    def step(out: Column, x: Column) -> Column:
        last = F.try_element_at(out, F.lit(-1))
        joins = (F.size(out) > 0) & (x.s <= last.e)
        return F.when(joins, F.concat(but_last(out), span(last.s, F.greatest(last.e, x.e)))).otherwise(F.concat(out, span(x.s, x.e)))

    def join_chunk(out: Column, chunk: Column) -> Column:
        last = F.try_element_at(out, F.lit(-1))
        inside = F.filter(chunk, lambda x: x.s <= last.e)
        longer = span(last.s, F.greatest(last.e, F.try_element_at(inside, F.lit(-1)).e))
        return F.when((F.size(out) > 0) & (F.size(inside) > 0), F.concat(but_last(out), longer, F.filter(chunk, lambda x: x.s > last.e))).otherwise(F.concat(out, chunk))

    merged = lambda chunks: F.aggregate(F.transform(chunks, lambda chunk: F.aggregate(chunk, none, step)), none, join_chunk)
    return in_chunks(F.array_sort(F.array_distinct(spans)), merged)


def replace_spans(text: Column, spans: Column, placeholder: str = NAME_PLACEHOLDER) -> Column:
    """Spans (in order, without overlaps, as merge_spans gives them) replaced where their stripped text has two characters
    at least. The text is cut once for each chunk of spans, and each piece of it into the parts between its spans."""

    def of(chunks: Column) -> Column:
        starts = F.transform(chunks, lambda chunk, k: F.when(k == 0, F.lit(0)).otherwise(F.get(F.get(chunks, k - 1), F.size(F.get(chunks, k - 1)) - 1).e))

        def piece(chunk: Column, base: Column) -> Column:
            until = F.greatest(F.try_element_at(chunk, F.lit(-1)).e, base)
            return let(F.substr(text, base + 1, until - base), lambda own: F.array_join(F.transform(chunk, lambda x, k: part(own, chunk, base, x, k)), ""))

        def part(own: Column, chunk: Column, base: Column, x: Column, k: Column) -> Column:
            before = F.when(k == 0, base).otherwise(F.get(chunk, k - 1).e)
            inner = F.substr(own, x.s - base + 1, x.e - x.s)
            kept = F.length(F.regexp_replace(inner, r"(?U)^\s+|\s+$", "")) >= 2
            return F.concat(F.substr(own, before - base + 1, x.s - before), F.when(kept, F.lit(placeholder)).otherwise(inner))

        end = F.try_element_at(F.flatten(chunks), F.lit(-1)).e
        return F.concat(F.array_join(F.zip_with(chunks, starts, piece), ""), F.substr(text, end + 1))

    done = let(spans, lambda own: F.when(F.size(own) > 0, in_chunks(own, lambda chunks: let(chunks, of))))
    return F.coalesce(done, text)


def name_scrubber(load: Callable[[], Callable[[list[str]], list[list[tuple[int, int]]]]]):
    """A pandas UDF text -> spans around a model. `load` runs once for each Python worker and returns a function from a batch
    of texts to their (start, end) spans; batches follow spark.sql.execution.arrow.maxRecordsPerBatch."""

    @F.pandas_udf(SPANS)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in batches:
            found = model(texts.fillna("").tolist())
            yield pd.Series([[{"s": int(s), "e": int(e)} for s, e in own] for own in found])

    return find


def scrub_names(df: DataFrame, load: Callable | None = None, text_col: str = "text") -> DataFrame:
    """Rules, then names. Texts that hold a name placeholder already are left alone; without a model only rules run."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    if load is None:
        return df.withColumn(text_col, scrub(text))
    done = df.withColumn("_ruled", scrub(text)).withColumn("_spans", merge_spans(name_scrubber(load)(F.col("_ruled"))))
    marked = F.contains(text, F.lit(NAME_PLACEHOLDER))
    return done.withColumn(text_col, F.when(marked, text).otherwise(replace_spans(F.col("_ruled"), F.col("_spans")))).drop("_ruled", "_spans")


def scrub_slice(df: DataFrame, load: Callable, start: int, size: int, *order: str, text_col: str = "text") -> DataFrame:
    """The rows from place `start` on, `size` of them at most, with `outcome`: 'done' before (a name placeholder stands in the
    text, which is left alone), 'scrubbed' (rules, then names), or 'failed': the model gave up on the text, which then
    stays as it is for the next run. One bad text fails neither its batch nor the slice."""

    @F.pandas_udf(SPANS)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()

        def one(text: str | None):
            try:
                return None if text is None else [{"s": int(s), "e": int(e)} for s, e in model([text])[0]]
            except Exception:  # noqa: BLE001  a model may raise anything; null says that it did
                return None

        for texts in batches:
            yield pd.Series([one(t) for t in texts], dtype=object)

    rows = slice_rows(df, start, start + size, *order)
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = F.contains(text, F.lit(NAME_PLACEHOLDER))
    found = rows.withColumn("_ruled", F.when(~marked, scrub(text))).withColumn("_spans", find(F.col("_ruled")))
    outcome = F.when(marked, "done").when(F.col("_spans").isNull(), "failed").otherwise("scrubbed")
    done = F.when(outcome == "scrubbed", replace_spans(F.col("_ruled"), merge_spans(F.col("_spans")))).otherwise(text)
    return found.withColumn("outcome", outcome).withColumn(text_col, done).drop("_ruled", "_spans", "row_index")


def scrub_in_slices(df: DataFrame, load: Callable, *order: str, text_col: str = "text") -> DataFrame:
    """All rows as scrub_slice does them. The slices of the rows are Spark's own partitions: each is a task, a lost one runs
    again, and a text on which the model fails is reported as 'failed'."""
    return scrub_slice(df, load, 0, (1 << 62), *order, text_col=text_col)
