"""Small column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_or_empty(column: Column | str) -> Column:
    """Missing texts count as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once: inside body it is a lambda variable, not an expression to repeat."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(column: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(column, r"(?U)^\s+|\s+$", "")


def strip_text(column: Column) -> Column:
    """strip for long texts: only those with white space at an end are searched for it."""

    def of(t: Column) -> Column:
        return F.when(F.concat(F.left(t, F.lit(1)), F.right(t, F.lit(1))).rlike(r"(?U)\s"), strip(t)).otherwise(t)

    return let(column, of)


def spaced(text: Column, but: str = "") -> Column:
    """Runs of white space (of any script, but not of the characters in `but`) as one blank each. Single blanks, which are
    nearly all runs, are no matches and cost no replacement."""
    return F.regexp_replace(text, rf"(?U)[^\S {but}][^\S{but}]*| [^\S{but}]+", " ")


def filled(df: DataFrame, column: str) -> DataFrame:
    """Rows whose column is neither null nor empty. A plain filter would be pushed below the projection that computes the
    column, and compute it twice; a generator over the finished column is not."""
    return df.select(*[F.explode(F.filter(F.array(c), lambda x: x != "")).alias(c) if c == column else c for c in df.columns])


def truthy(column: Column | str) -> Column:
    """The value, or null where it is null or empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column.cast("string") != "", column)


def in_chunks(items: Column, body: Callable[[Column], Column]) -> Column:
    """body(chunks) of an array cut into about as many chunks as each has items. What is quadratic within a chunk, or in
    their number, is close to linear in the array."""

    def of(whole: Column) -> Column:
        width = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(whole))).cast("int"))
        last = F.floor((F.greatest(F.size(whole), F.lit(1)) - 1) / width).cast("int")
        return body(F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(whole, k * width + 1, width)))

    return let(items, of)
