"""Text cleaning as columns: Unicode, white space, court texts, wiki markup, and the router by source.

Steps run in a fixed order that results depend on: niqqud goes before punctuation is mapped, so U+05BE is deleted and never
becomes a hyphen; blank lines are squeezed in one pass and may remain after it.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.config import CONTROL, HEBREW, NIQQUD, PUNCTUATION, ZERO_WIDTH
from corpusmill.functions.columns import filled, let, spaced, strip, strip_text, text_or_empty, truthy


@F.pandas_udf(T.StringType())
def _nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


#: Characters that NFC leaves alone wherever they stand: those before the first combining mark, and Hebrew letters.
STABLE = r"^[\x00-\u02FF\u05D0-\u05EA]*$"


def nfc(text: Column) -> Column:
    """Unicode NFC. Spark has no such function; texts of stable characters throughout never leave the JVM with their content."""
    return F.coalesce(_nfc(F.when(~text.rlike(STABLE), text)), text)


def squeeze_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\n{3,}", "\n\n")


def _bare(t: Column) -> Column:
    """Without niqqud, zero-width and control characters, with Hebrew punctuation mapped and apart from Latin letters.

    What a text can't hold isn't searched for: ASCII texts hold control characters at most, and punctuation is Hebrew."""
    bare = F.regexp_replace(t, f"[{NIQQUD}{ZERO_WIDTH}{CONTROL}]", "")
    mapped = reduce(lambda x, pair: F.replace(x, F.lit(pair[0]), F.lit(pair[1])), PUNCTUATION.items(), bare)
    apart = F.regexp_replace(F.regexp_replace(mapped, f"({HEBREW})([a-zA-Z])", "$1 $2"), f"([a-zA-Z])({HEBREW})", "$1 $2")
    return F.when(t.rlike(r"^\p{ASCII}*$"), F.regexp_replace(t, CONTROL, "")).when(t.rlike(HEBREW), apart).otherwise(bare)


def _squeezed(t: Column) -> Column:
    """Lines of blanks alone go, then blank lines are squeezed."""
    bare = F.when(F.contains(t, F.lit("\n ")), F.regexp_replace(t, r"\n[ \t]+\n", "\n\n")).otherwise(t)
    return F.when(F.contains(t, F.lit("\n\n")) | F.contains(t, F.lit("\n ")), squeeze_newlines(bare)).otherwise(t)


def clean_text(text: Column, normalise: bool = True) -> Column:
    """General cleaning of a text; with normalise=False without NFC, and then JVM-side throughout."""
    out = let(nfc(text) if normalise else text, _bare)
    return strip_text(let(spaced(out, r"\n"), _squeezed))


def clean_lines(text: Column) -> Column:
    """Court texts: every line stripped, runs of blank lines cut to one."""
    return squeeze_newlines(F.array_join(F.transform(F.split(text, "\n", -1), strip), "\n"))


def drop_templates(text: Column) -> Column:
    """Without {{...}}, innermost first until none is left: as many passes over the text as templates are nested, and one
    that finds none. The steps behind that one (there are as many as opening braces) cost nothing."""

    pattern = r"\{\{[^{}]*\}\}"

    def step(state: Column, _: Column) -> Column:
        # No lambda within this one: Spark 4.1 then no longer finds a Python function around it, and fails.
        return F.when(state.done, state).otherwise(F.struct(F.regexp_replace(state.t, pattern, "").alias("t"), (~state.t.rlike(pattern)).alias("done")))

    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.regexp_count(text, F.lit(r"\{"))))
    bare = F.aggregate(steps, F.struct(text.alias("t"), F.lit(False).alias("done")), step, lambda state: state.t)
    return F.when(F.contains(text, F.lit("{{")), bare).otherwise(text)


def clean_wikitext(text: Column) -> Column:
    """Wiki markup to plain text: templates, tables, links, external links, tags, quotes and heading marks."""
    out = let(text, drop_templates)
    # Markup patterns in the order they are applied.
    for pattern, to in (
        (r"(?s)\{\|.*?\|\}", ""),
        (r"\[\[(?:[^|\]]*\|)?([^\]]*)\]\]", "$1"),
        (r"\[https?://[^\s\]]+(?: ([^\]]*))?\]", "$1"),
        (r"<[^>]+>", ""),
    ):
        out = F.regexp_replace(out, pattern, to)
    return reduce(lambda t, mark: F.replace(t, F.lit(mark), F.lit("")), ("'''", "''", "=="), out)


def strip_wikitext(text: Column) -> Column:
    """The simpler rules of the download side: one template pass, named links, quotes; tables and headings stay."""
    out = text
    # Markup patterns in the order they are applied.
    for pattern, to in (
        (r"\{\{[^}]*\}\}", ""),
        (r"\[\[[^|\]]*\|([^\]]*)\]\]", "$1"),
        (r"\[\[([^\]]*)\]\]", "$1"),
        (r"(?U)\[https?://\S+\s+([^\]]+)\]", "$1"),
        (r"<[^>]+>", ""),
        (r"'{2,}", ""),
    ):
        out = F.regexp_replace(out, pattern, to)
    return strip(squeeze_newlines(out))


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, r"<[^>]+>", "")


#: Metadata that court documents keep, and that wiki documents keep.
COURT_META = ("case_id", "case_num", "date", "year", "type", "judges", "parties", "court", "division")
WIKI_META = ("categories", "url")


def clean_documents(df: DataFrame, normalise: bool = True) -> DataFrame:
    """Route rows by source_dir: court and the two wiki sources are cleaned, others and empty results go.

    Needs source_dir; reads text, wikitext, title and metadata columns where the table has them. Returns key columns
    (those not read), source_dir, source, title, text and meta. Wiki rows take wikitext, or text where that is empty.
    """
    have = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    source = F.col("source_dir")
    is_court, is_wiki = source == "court", source.isin("kolzchut", "wikisource_laws")
    body = F.when(is_court, clean_lines(text_or_empty(have("text")))).when(is_wiki, clean_wikitext(F.coalesce(truthy(have("wikitext")), text_or_empty(have("text")))))
    meta = F.to_json(F.struct(*[F.when(is_court, have(c)).alias(c) for c in COURT_META], *[F.when(is_wiki, have(c)).alias(c) for c in WIKI_META]))
    read = {"text", "wikitext", "title", "source", *COURT_META, *WIKI_META, "source_dir"}
    # A text is finished before the general cleaning, which names it several times, and that before empty ones go.
    out = df.where(is_court | is_wiki).select(
        *[c for c in df.columns if c not in read], "source_dir", F.when(source == "wikisource_laws", "wikisource").otherwise(source).alias("source"), F.coalesce(have("title"), F.lit("")).alias("title"), body.alias("text"), meta.alias("meta")
    )
    return filled(out.withColumn("text", clean_text(F.col("text"), normalise)), "text")


def law_text(df: DataFrame, *keep: str) -> DataFrame:
    """Law records to documents: key fallbacks, then labelled non-empty parts, one a line. Columns of `keep` stay.

    A key that is present counts even if its value is null; fallbacks only stand in for columns that the table lacks.
    """
    have = lambda *names: next((F.col(n).cast("string") for n in names if n in df.columns), F.lit(""))
    title, kind, date = have("Name", "KNS_LawName"), have("TypeDesc", "SubTypeDesc"), have("PublicationDate", "LastUpdatedDate")
    # Labels of the parts.
    parts = [F.when(value != "", F.concat(F.lit(label), value)) for label, value in (("שם החוק: ", title), ("סוג: ", kind), ("תאריך פרסום: ", date))]
    more = [F.when(F.col(c).cast("string") != "", F.concat(F.lit(f"{c}: "), F.col(c).cast("string"))) for c in ("LawDesc", "Description", "Text", "SubTypeDesc", "StatusDesc") if c in df.columns]
    return df.select(have("LawID", "Id").alias("law_id"), title.alias("title"), kind.alias("type"), date.alias("publication_date"), F.concat_ws("\n", *parts, *more).alias("text"), F.lit("knesset").alias("source"), *keep)
