"""Whole runs: clean, scrub, filter, dedup and format as one chain of transforms, and its command line."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from corpusmill.config import HEBREW_PROFILE, LATIN_PROFILE, FilterConfig, FormatConfig
from corpusmill.functions.columns import filled, text_or_empty
from corpusmill.functions.scrub import scrub_documents
from corpusmill.functions.signals import filter_documents
from corpusmill.functions.text import clean_documents, clean_text
from corpusmill.operators.dedup import dedup
from corpusmill.operators.stats import corpus_stats, stage_counts
from corpusmill.operators.tables import Tables
from corpusmill.operators.training import split_stats, upsample, with_split
from corpusmill.sources.files import RAW_SOURCES, read_sources, write_stage, write_training

STEPS = ("clean", "pii", "filter", "dedup", "format")


def clean_step(df: DataFrame) -> DataFrame:
    """Rows with source_dir are raw documents: each source's own rules, other sources go. Rows without are plain texts."""
    if "source_dir" in df.columns:
        return clean_documents(df)
    return filled(df.withColumn("text", clean_text(text_or_empty("text"))), "text")


def run(df: DataFrame, profile: FilterConfig = HEBREW_PROFILE, near: bool = True, config: FormatConfig | None = None, last: str = "format") -> dict[str, DataFrame]:
    """The steps up to `last` over a table with doc_id and text, and source or source_dir, as tables by step. Scrubbing comes
    before dedup: placeholders can make documents equal.

    Each step's rows are stored for the steps behind it: nothing is computed twice, and a filter on a column that is
    computed from a cleaned text is not pushed below the cleaning, where it would repeat its expressions.
    """
    tables, wanted = Tables(df.sparkSession, "run"), STEPS[: STEPS.index(last) + 1]
    keep = lambda step, rows: rows if step == last else tables.save(rows)  # noqa: E731  what nothing reads again isn't stored
    out = {"clean": keep("clean", clean_step(df))}
    if "pii" in wanted:
        out["pii"] = keep("pii", scrub_documents(out["clean"]).drop("modified"))
    if "filter" in wanted:
        out["filter"] = keep("filter", filter_documents(out["pii"], profile))
    if "dedup" in wanted:
        out["dedup"] = keep("dedup", dedup(out["filter"], near=near))
    if "format" in wanted:
        out["format"] = upsample(with_split(out["dedup"], config=config), config=config)
    return out


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="corpusmill", description="Prepare a text corpus.")
    parser.add_argument("--step", choices=(*STEPS, "stats", "analyze", "all"), default="all")
    parser.add_argument("--raw", required=True, help="folder of raw documents, one folder a source, or a Parquet table with doc_id, source, text")
    parser.add_argument("--out", required=True, help="folder of stage outputs")
    parser.add_argument("--profile", choices=("hebrew", "latin"), default="hebrew")
    parser.add_argument("--no-near", action="store_true", help="exact dedup only")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("corpusmill").getOrCreate()
    raw = spark.read.parquet(args.raw) if args.raw.rstrip("/").endswith(".parquet") else read_sources(spark, args.raw, list(RAW_SOURCES))
    last = {"stats": "format", "all": "format", "analyze": "filter"}.get(args.step, args.step)
    steps = run(raw, HEBREW_PROFILE if args.profile == "hebrew" else LATIN_PROFILE, not args.no_near, last=last)
    if args.step == "stats":
        stage_counts(steps).show(200, False)
    elif args.step == "analyze":
        corpus_stats(steps["filter"]).show(200, False)
    else:
        for step in STEPS if args.step == "all" else (args.step,):
            if step == "format":
                write_training(steps[step], f"{args.out}/training")
                split_stats(with_split(steps["dedup"])).show(200, False)
            else:
                write_stage(steps[step], f"{args.out}/{step}")


if __name__ == "__main__":
    main()
