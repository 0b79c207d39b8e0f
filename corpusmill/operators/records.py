"""Raw records to documents: court scans, wiki replies, and law records with a title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.columns import text_or_empty, truthy
from corpusmill.functions.text import law_text, strip_wikitext
from corpusmill.operators.store import fallback_id, long_enough, numbered, page_url

# Field of a document <- columns that it is read from, the first one that the table has.
COURT_FIELDS = {
    "judgment_id": ("judgment_id",), "title": ("title",), "case_number": ("name_number",), "date": ("doc_create_date",), "court_type": ("court_type_label",), "district": ("district_label",),
    "subject": ("publication_subject_label",), "judges": ("judges_str",), "text": ("document_text",),
}
SUPREME_FIELDS = {
    "case_id": ("case_id",), "case_num": ("CaseNum", "case_nbr"), "case_name": ("CaseName", "meta_case_nm"), "title": ("html_title",), "date": ("VerdictDt", "meta_verdict_dt"), "year": ("Year",), "type": ("Type",),
    "judges": ("meta_judge",), "parties": ("meta_side_nm",), "lawyers": ("meta_lawyer_nm",), "court": ("meta_court_nm",), "division": ("meta_mador_nm",), "text": ("text",),
}
LISTS = ("judges", "parties", "lawyers")


def _fields(df: DataFrame, fields: dict[str, tuple[str, ...]], lists: tuple[str, ...] = ()) -> list[Column]:
    """A column that is there counts even if it is null; missing ones are empty."""
    empty = lambda field: F.array().cast("array<string>") if field in lists else F.lit("")
    return [next((F.col(c) for c in names if c in df.columns), empty(field)).alias(field) for field, names in fields.items()]


def _scan(df: DataFrame, order: str, fields: list[Column], ids: tuple[str, ...], prefix: str, source: str, least: int) -> DataFrame:
    docs = long_enough(df.select(F.col(order).alias("_order"), *fields), least)
    known = F.coalesce(*[truthy(c) for c in ids]).isNotNull()
    named = docs.where(known).withColumn("store_id", fallback_id(prefix, *[F.col(c) for c in ids]))
    # The running index counts the documents kept before; only keys are ranged for it, and only rows without an id join it.
    places = numbered(docs.select("_order"), "_order")
    placed = docs.where(~known).join(places, "_order").withColumn("store_id", F.concat(F.lit(prefix), F.col("row_index"))).drop("row_index")
    return named.unionByName(placed).withColumn("source", F.lit(source)).drop("_order")


def court_judgments(df: DataFrame, order: str) -> DataFrame:
    """Judgments of 100 characters at least, as documents of ten fields and store_id: judgment_id, or the case number, or the
    place among those kept. `order` tells the rows apart and gives their order."""
    return _scan(df, order, _fields(df, COURT_FIELDS), ("judgment_id", "case_number"), "gc_", "court_guychuk", 100)


def supreme_judgments(df: DataFrame, order: str) -> DataFrame:
    """Supreme court documents of 200 characters at least, as documents of fourteen fields and store_id: case_id, or the case
    number, or the place among those kept."""
    return _scan(df, order, _fields(df, SUPREME_FIELDS, LISTS), ("case_id", "case_num"), "sc_", "court_supreme", 200)


def skipped_short(df: DataFrame, least: int, text_col: str) -> DataFrame:
    """saved and skipped, one row."""
    short = F.length(text_or_empty(text_col)) < least
    return df.agg(F.count_if(~short).alias("saved"), F.count_if(short).alias("skipped"))


def page_records(df: DataFrame, base: str, source: str, least: int = 0, title: str = "title", reply: str = "reply") -> DataFrame:
    """Replies of a wiki's parse call (JSON) to documents: title, wikitext, text, categories, source, url. Replies without a
    parse result go, and so do texts below `least` characters."""
    kind = "struct<parse:struct<wikitext:struct<`*`:string>,categories:array<struct<`*`:string>>>>"
    parsed = df.withColumn("_parse", F.from_json(F.col(reply), kind)["parse"]).where("_parse IS NOT NULL")
    wikitext = F.coalesce(F.col("_parse")["wikitext"]["*"], F.lit(""))
    categories = F.coalesce(F.transform(F.col("_parse")["categories"], lambda c: c["*"]), F.array().cast("array<string>"))
    docs = parsed.select(
        *[c for c in df.columns if c not in (title, reply)], F.col(title).alias("title"), wikitext.alias("wikitext"), strip_wikitext(wikitext).alias("text"), categories.alias("categories"), F.lit(source).alias("source"), page_url(base, F.col(title)).alias("url")
    )
    return long_enough(docs, least) if least else docs


def law_documents(df: DataFrame) -> DataFrame:
    """Law records with a title, as documents; raw_fields holds the record itself as JSON, store_id its id or else its title."""
    raw = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    docs = law_text(df.withColumn("_raw", raw), "_raw")
    docs = docs.withColumnRenamed("_raw", "raw_fields").withColumn("store_id", F.coalesce(truthy("law_id"), F.col("title")))
    return docs.where(F.coalesce(F.col("title"), F.lit("")) != "")
