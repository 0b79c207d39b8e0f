"""Connected components of a distributed edge table by alternating large-star and small-star steps.

Each step is an aggregate (partly done before its shuffle) and an equi-join that adaptive execution can split, so a hub
with very many neighbours never lands in one task. Tables between steps are written to the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """edges: (u, v), u <> v, in any order, repeats allowed. Returns (id, component) of every node that is not the smallest
    of its component; component is the smallest node reachable."""
    now = scratch.save(edges.select("u", "v").distinct(), "edges", narrow=True)
    before = _digest(now)
    while True:
        large = scratch.save(_large_star(now), "large-star", narrow=True)
        small = scratch.save(_small_star(large), "small-star", narrow=True)
        after = _digest(small)
        scratch.drop(now, large)
        now = small
        if after == before:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before = after
