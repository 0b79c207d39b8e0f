"""Rule-based scrubbing of personal data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.config import NAME_PLACEHOLDER, SCRUB_DIGITS, SCRUB_RULES, STRICT_SCRUB_RULES
from corpusmill.functions.columns import let, text_or_empty


def scrub(text: Column, strict: bool = False) -> Column:
    """All rules in their order. strict=True also repairs international prefixes and unseparated landlines.

    Most texts hold neither an at sign nor nine digits in a row, and no rule can match in them: one search tells."""
    rules = STRICT_SCRUB_RULES if strict else SCRUB_RULES
    by = lambda t, own: reduce(lambda x, rule: F.regexp_replace(x, rule[0], F.lit(rule[1])), own, t)
    return let(text, lambda t: F.when(t.rlike(SCRUB_DIGITS), by(t, rules)).when(F.contains(t, F.lit("@")), by(t, [r for r in rules if "@" in r[0]])).otherwise(t))


def scrub_documents(df: DataFrame, text_col: str = "text", skip_marked: bool = False, strict: bool = False) -> DataFrame:
    """df with scrubbed texts and `modified`. skip_marked leaves texts alone that already hold a name placeholder."""
    text = text_or_empty(text_col)
    done = scrub(text, strict)
    done = F.when(F.contains(text, F.lit(NAME_PLACEHOLDER)), text).otherwise(done) if skip_marked else done
    return df.withColumn("_scrubbed", done).withColumn("modified", F.col("_scrubbed") != text).withColumn(text_col, F.col("_scrubbed")).drop("_scrubbed")


def scrub_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents and modified documents by source."""
    return scrub_documents(df, text_col).groupBy("source").agg(F.count("*").alias("total"), F.count_if("modified").alias("modified"))
