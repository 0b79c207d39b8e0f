"""Corpus statistics and samples by source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.columns import text_or_empty
from corpusmill.functions.signals import word_count
from corpusmill.operators.tables import Tables


def seeded_place(key: Column, seed: int = 42) -> Column:
    """A place in a seeded order that any engine with md5 can tell."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"#{seed}")))


def sample_per_source(df: DataFrame, k: int, source: str = "source", key: str = "doc_id", seed: int = 42) -> DataFrame:
    """k rows of each source at most, without replacement. Spark keeps k rows for each source in every task before the shuffle."""
    place = F.row_number().over(Window.partitionBy(source).orderBy(seeded_place(F.col(key), seed), key))
    return df.withColumn("sample_rank", place).where(F.col("sample_rank") <= k)


def index_quantiles(df: DataFrame, value: str, source: str = "source") -> DataFrame:
    """Values at the 0-based places n div 2, n div 10 and 9n div 10 of each source's sorted values, and counts.

    Values are counted first; places are found from running counts over distinct values, so a large source costs its
    distinct values, not its rows.
    """
    counts = df.groupBy(source, value).agg(F.count("*").alias("c"))
    through = F.sum("c").over(Window.partitionBy(source).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    whole = Window.partitionBy(source)
    ranked = counts.withColumn("through", through).withColumn("n", F.sum("c").over(whole)).withColumn("total", F.sum(F.col(value) * F.col("c")).over(whole))
    at = lambda place: F.min(F.when(F.col("through") > place, F.col(value)))
    return ranked.groupBy(source).agg(
        F.max("n").alias("documents"), at(F.floor(F.col("n") / 2)).alias("median"), at(F.floor(F.col("n") / 10)).alias("p10"), at(F.floor(F.col("n") * 9 / 10)).alias("p90"), F.floor(F.max("total") / F.max("n")).alias("mean")
    )


def corpus_stats(df: DataFrame, source: str = "source", text_col: str = "text") -> DataFrame:
    """Index quantiles of characters and of words by source."""
    sized = df.select(source, F.length(text_or_empty(text_col)).cast("long").alias("chars"), word_count(text_or_empty(text_col)).cast("long").alias("words"))
    chars = index_quantiles(sized, "chars", source)
    words = index_quantiles(sized, "words", source).select(F.col(source).alias("_s"), F.col("median").alias("median_words"), F.col("mean").alias("mean_words"))
    joined = chars.join(words, F.col(source).eqNullSafe(F.col("_s"))).drop("_s")
    return joined.select(source, "documents", F.col("median").alias("median_chars"), F.col("p10").alias("p10_chars"), F.col("p90").alias("p90_chars"), F.col("mean").alias("mean_chars"), "median_words", "mean_words")


def tokenizer_stats(df: DataFrame, count_tokens=None, text_col: str = "text", name: str = "whitespace") -> DataFrame:
    """One row for a tokenizer: documents, tokens, characters a token and tokens a word. count_tokens: text column -> tokens."""
    text = text_or_empty(text_col)
    tokens = (count_tokens or word_count)(text)
    sums = df.select(F.length(text).cast("long").alias("c"), word_count(text).cast("long").alias("w"), tokens.cast("long").alias("t")).agg(F.count("*").alias("documents"), F.sum("c").alias("chars"), F.sum("w").alias("words"), F.sum("t").alias("tokens"))
    return sums.select(F.lit(name).alias("tokenizer"), "documents", "tokens", F.round(F.col("chars") / F.col("tokens"), 6).alias("chars_per_token"), F.round(F.col("tokens") / F.col("words"), 6).alias("tokens_per_word"))


def tokenizer_table(df: DataFrame, tokenizers: dict[str, Callable[[], Callable[[Column], Column]]], per_source: int = 166, chars: int = 5000, source: str = "source", key: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """tokenizer_stats of several tokenizers on a seeded sample of each source, texts cut to `chars`, with estimated_tokens,
    the sample's mean carried on to all rows. A tokenizer that can't be loaded or run is left out; what went wrong comes back
    by name. tokenizers: name -> a function that loads it and returns text column -> tokens."""
    tables, total = Tables(df.sparkSession, "tokenizers"), df.count()
    picked = sample_per_source(df.select(source, key, F.substring(text_or_empty(text_col), 1, chars).alias("_text")), per_source, source, key)
    sample, out, failed = tables.save(picked.select("_text")), None, {}
    for name, load in tokenizers.items():
        try:
            one = tables.save(tokenizer_stats(sample, load(), "_text", name))
        except Exception as error:  # noqa: BLE001  a tokenizer may fail in any way; the others count
            failed[name] = f"{type(error).__name__}: {error}".splitlines()[0]
            continue
        one = one.withColumn("estimated_tokens", F.floor(F.col("tokens") / F.col("documents") * F.lit(total)))
        out = one if out is None else out.unionByName(one)
    return out, failed


def stage_counts(stages: dict[str, DataFrame], source: str = "source") -> DataFrame:
    """Rows by stage and source."""
    out = None
    for name, df in stages.items():
        part = df.groupBy(source).agg(F.count("*").alias("documents")).select(F.lit(name).alias("stage"), source, "documents")
        out = part if out is None else out.unionByName(part)
    return out
