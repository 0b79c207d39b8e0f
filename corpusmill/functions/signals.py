"""Quality signals of a text and the first filter that it fails, as JVM-side columns."""

from __future__ import annotations

import re
from functools import cache, reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.config import BOILERPLATE, BOILERPLATE_WORDS, HEBREW_PROFILE, FilterConfig
from corpusmill.functions.columns import let, strip, text_or_empty


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+", -1), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def alpha_ratio(text: Column) -> Column:
    """Letters over all characters; 0 for an empty text."""
    return F.when(text == "", F.lit(0.0)).otherwise(F.length(F.regexp_replace(text, r"[^\p{L}]+", "")) / F.length(text))


def script_ratio(text: Column, config: FilterConfig = HEBREW_PROFILE) -> Column:
    """Letters of the wanted script over all letters counted; 0 without any."""
    # Counted by what is left without them: Java tests a negated class of several ranges ten times slower than the class.
    without = lambda t, c: F.regexp_replace(t, f"{c}+", "")
    if not _within(config.script, config.letters):
        letters, wanted = (F.length(text) - F.length(without(text, c)) for c in (config.letters, config.script))
        return F.when(letters == 0, F.lit(0.0)).otherwise(wanted / letters)
    # Wanted letters are letters: the others are counted in what is left without the wanted ones.
    rests = F.transform(F.array(without(text, config.script)), lambda rest: F.struct(F.length(rest).alias("rest"), F.length(without(rest, config.letters)).alias("none")))
    sizes = F.struct(F.length(text).alias("all"), F.element_at(rests, 1).alias("of"))
    return let(sizes, lambda n: F.when(n["all"] == n["of"]["none"], F.lit(0.0)).otherwise((n["all"] - n["of"]["rest"]) / (n["all"] - n["of"]["none"])))


@cache
def _within(inner: str, outer: str) -> bool:
    """Whether a class of single characters (of the basic plane) lies in another."""
    plane = "".join(map(chr, range(0x10000)))
    return set(re.findall(inner, plane)) <= set(re.findall(outer, plane))


def ngram_repetition(text: Column, n: int = 5) -> Column:
    """Words in repeated n-grams over all words, at most 1: a repeated n-gram counts n words for each repeat.

    The sum of repeats is total minus distinct n-grams. n-grams are compared by 64-bit hashes of their words.
    """

    def of(w: Column) -> Column:
        total = F.size(w) - (n - 1)
        grams = F.transform(F.slice(w, 1, F.greatest(total, F.lit(0))), lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, n)]))
        return F.when(total < 1, F.lit(0.0)).otherwise(F.least((total - F.size(F.array_distinct(grams))) * F.lit(float(n)) / F.size(w), F.lit(1.0)))

    return let(words(text), of)


def duplicate_line_ratio(text: Column) -> Column:
    """Characters in repeats of non-blank lines over characters in lines; 0 without any. Lines are compared as they are."""

    def of(lines: Column) -> Column:
        total = F.length(F.array_join(lines, ""))
        own = F.filter(lines, lambda x: x.rlike(r"(?U)\S"))
        repeats = F.length(F.array_join(own, "")) - F.length(F.array_join(F.array_distinct(own), ""))
        return F.when(total == 0, F.lit(0.0)).otherwise(repeats / total)

    return let(F.split(text, "\n", -1), of)


def short_line_ratio(text: Column, shorter_than: int = 30) -> Column:
    """Short lines over non-blank lines; 1 without any."""

    def of(lines: Column) -> Column:
        return F.when(F.size(lines) == 0, F.lit(1.0)).otherwise(F.size(F.filter(lines, lambda x: F.length(x) < shorter_than)) / F.size(lines))

    return let(F.filter(F.transform(F.split(text, "\n", -1), strip), lambda x: x != ""), of)


def boilerplate_ratio(text: Column, patterns: tuple[str, ...] = BOILERPLATE) -> Column:
    """Characters that patterns match over all characters, at most 1; overlaps of different patterns count twice."""

    def of(p: str) -> Column:
        found = F.length(text) - F.length(F.regexp_replace(text, p, ""))
        words_ = [F.contains(text, F.lit(w)) for w in BOILERPLATE_WORDS.get(p, ())]
        return F.when(reduce(or_, words_), found).otherwise(0) if words_ else found

    matched = sum((of(p) for p in patterns), F.lit(0))
    return F.when(text == "", F.lit(0.0)).otherwise(F.least(matched / F.length(text), F.lit(1.0)))


def signals(text: Column, config: FilterConfig = HEBREW_PROFILE) -> dict[str, Column]:
    return {
        "word_count": word_count(text),
        "alpha_ratio": alpha_ratio(text),
        config.script_name: script_ratio(text, config),
        "word_repetition": ngram_repetition(text),
        "duplicate_lines": duplicate_line_ratio(text),
        "short_lines": short_line_ratio(text, config.short_line),
        "boilerplate": boilerplate_ratio(text),
    }


def reject_reason(text: Column, config: FilterConfig = HEBREW_PROFILE) -> Column:
    """The name of the first failed filter, or null. Later signals are only computed where earlier ones pass."""
    s = signals(text, config)
    return (
        F.when(s["word_count"] < config.min_words, "min_length")
        .when(s["alpha_ratio"] < config.min_alpha_ratio, "alpha_ratio")
        .when(s[config.script_name] < config.min_script_ratio, config.script_name)
        .when(s["word_repetition"] > config.max_word_repetition, "word_repetition")
        .when(s["duplicate_lines"] > config.max_duplicate_lines, "duplicate_lines")
        .when(s["short_lines"] > config.max_short_lines, "short_lines")
        .when(s["boilerplate"] > config.max_boilerplate, "boilerplate")
    )


def with_reason(df: DataFrame, config: FilterConfig = HEBREW_PROFILE, text_col: str = "text") -> DataFrame:
    return df.withColumn("reject_reason", reject_reason(text_or_empty(text_col), config))


def filter_documents(df: DataFrame, config: FilterConfig = HEBREW_PROFILE, text_col: str = "text") -> DataFrame:
    """Documents that pass all filters."""
    return with_reason(df, config, text_col).where("reject_reason IS NULL").drop("reject_reason")


def filter_stats(df: DataFrame, config: FilterConfig = HEBREW_PROFILE) -> DataFrame:
    """Rows by source and reason ('kept' for those that pass)."""
    named = with_reason(df.select("source", "text"), config).select("source", F.coalesce("reject_reason", F.lit("kept")).alias("reason"))
    return named.groupBy("source", "reason").agg(F.count("*").alias("documents"))
