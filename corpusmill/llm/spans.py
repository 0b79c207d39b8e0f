"""Regex spans with code point offsets, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.columns import in_chunks, let

SPAN = "struct<s:int,e:int,t:string,before:string,after:string>"


def regex_spans(text: Column, pattern: str, fits: Callable[[Column], Column] | None = None, context: bool = False, guard: Column | None = None) -> Column:
    """All leftmost non-overlapping matches of a Java pattern as an array of (s, e, t): offsets in code points, end
    exclusive, and the matched text; with context also the texts between it and its neighbours. Matches that `fits`
    refuses are left out; nothing is tried in their place. guard is a cheap condition without which a text has no match.

    Spark returns matches without offsets. The texts between matches come from splitting by the same pattern, and
    offsets are running sums of both lengths, taken over chunks and then within each chunk.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    after = F.slice(between, 2, F.size(found)) if context else F.transform(found, lambda _: F.lit(None).cast("string"))
    zipped = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("gap"), found.alias("hit"), after.alias("after"))
    none, offsets = F.array().cast(f"array<{SPAN}>"), F.array().cast("array<int>")

    def span(state: Column, x: Column) -> Column:
        start = state.at + F.length(x.gap)
        end = start + F.length(x.hit)
        before = x.gap if context else F.lit(None).cast("string")
        one = F.struct(start.alias("s"), end.alias("e"), x.hit.alias("t"), before.alias("before"), x.after.alias("after"))
        return F.struct(end.alias("at"), F.concat(state.out, F.array(one)).alias("out"))

    def chunk_start(state: Column, chunk: Column) -> Column:
        behind = F.aggregate(chunk, state.at, lambda at, x: at + F.length(x.gap) + F.length(x.hit))
        return F.struct(behind.alias("at"), F.concat(state.out, F.array(state.at)).alias("out"))

    def of(chunks: Column) -> Column:
        starts = F.aggregate(chunks, F.struct(F.lit(0).alias("at"), offsets.alias("out")), chunk_start, lambda state: state.out)
        return F.flatten(F.zip_with(chunks, starts, lambda chunk, at: F.aggregate(chunk, F.struct(at.alias("at"), none.alias("out")), span, lambda state: state.out)))

    spans = in_chunks(zipped, lambda chunks: let(chunks, of))
    spans = F.filter(spans, lambda x: fits(x.t)) if fits else spans
    some = F.when(F.size(found) > 0, spans).otherwise(none)
    return some if guard is None else F.when(guard, some).otherwise(none)
