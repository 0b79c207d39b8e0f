"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

All sources share the corpus' total size by weight. A source is clamped at `max_epochs` times its own size; what it
cannot take is shared again among the others by weight, until no target is above its clamp. With the sources ordered
by clamp per unit of weight this fixpoint has a closed form: the clamped ones are a prefix, and the water level is the
total less the prefix' clamps, over the weights that remain.

A source that takes 2.3 epochs takes each document twice and a seeded choice of whole documents a third time, the last
of them for a fraction of its words, so that the words taken meet the target. The choice follows the documents' hash
order, found by prefix sums on two levels: sizes are summed for each (source, hash bucket) before any shuffle, and only
the one bucket in which a source's target falls is ordered row by row. No task ever holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import SPACE_CLASS, WORD_PATTERN, Scratch, blank, read_table

#: Weights of the sources in code point order, repeating (a fixed value of the contract).
WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = 17
#: Hash buckets of the seeded order: LEVEL coarse ones, each of LEVEL fine ones.
LEVEL = 1 << 8
BUCKETS = LEVEL * LEVEL


def word_count(text: Column) -> Column:
    return F.regexp_count(blank(text), F.lit(WORD_PATTERN)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """sizes: (source, source_size), one row per source. Adds weight and target. Works on as many rows as there are sources."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    clamp = F.col("source_size") * F.lit(max_epochs)
    ordered = Window.orderBy(F.col("clamp") / F.col("weight"), F.col("source").asc_nulls_last())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("clamp").over(before), F.lit(0))) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    filled = sizes.withColumn("weight", weight).withColumn("clamp", clamp).withColumn("level", level).withColumn("fits", F.col("level") * F.col("weight") <= F.col("clamp"))
    water = F.first(F.when(F.col("fits"), F.col("level")), ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.least(F.col("clamp").cast("double"), F.coalesce(F.col("water") * F.col("weight"), F.col("clamp").cast("double"))))
    return filled.withColumn("water", water).select("source", "source_size", "weight", target.alias("target"))


def _placed(df: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """Adds _source, _size, _place (seeded order: the first 60 bits of an md5) and _bucket (its top 16 bits); they depend on
    id and text alone, and any engine with md5 can tell them."""
    place = F.conv(F.substring(F.md5(F.concat_ws("/", F.lit(str(seed)), blank(F.col(id_col)), blank(F.col(text_col)))), 1, 15), 16, 10).cast("long")
    out = df.withColumn("_source", F.col(source_col).cast("string")).withColumn("_size", word_count(F.col(text_col))).withColumn("_place", place)
    return out.withColumn("_bucket", F.shiftright("_place", 44).cast("int"))


def _edge(sums: DataFrame, targets: DataFrame) -> DataFrame:
    """sums: (_source, key, words), at most LEVEL keys a source. Adds to targets (which has before and quota) the key in
    which the quota ends and the words before it; a quota that no key holds ends behind all of them."""
    earlier = Window.partitionBy("_source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("sum_before", F.coalesce(F.sum("words").over(earlier), F.lit(0).cast("long")))
    both = targets.join(sums, F.col("source").eqNullSafe(F.col("_source")), "left")
    low = F.col("before") + F.col("sum_before")
    holds = (low <= F.col("quota")) & (F.col("quota") < low + F.col("words"))
    group = [c for c in targets.columns if c != "before"]
    return both.groupBy(*group).agg(F.max(F.when(holds, F.col("key"))).alias("key"), F.coalesce(F.max(F.when(holds, low)), F.lit(0).cast("long")).alias("before"))


def _plan(placed: DataFrame, scratch: Scratch, max_epochs: int) -> DataFrame:
    """One row per source: target, whole epochs, quota of words for the fractional one, and the hash bucket where the quota ends.

    The bucket is found from coarse sums, then from fine sums within the one coarse bucket, so that no window sees more
    than LEVEL rows of a source, however many documents it has.
    """
    coarse = F.shiftright("_bucket", 8)
    sums = scratch.save(placed.groupBy("_source", coarse.alias("key")).agg(F.sum("_size").alias("words")), "coarse")
    sizes = sums.groupBy(F.col("_source").alias("source")).agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, max_epochs=max_epochs)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.withColumn("epochs", F.least(F.floor(ratio), F.lit(max_epochs)).cast("long"))
    targets = targets.withColumn("quota", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    targets = targets.select("source", "source_size", "target", "epochs", "quota", F.lit(0).cast("long").alias("before"))
    first = scratch.save(_edge(sums, targets), "coarse-edges")
    near = placed.join(first.select(F.col("source").alias("edge_source"), F.col("key").alias("edge_key")), F.col("_source").eqNullSafe(F.col("edge_source")) & (coarse == F.col("edge_key")), "left_semi")
    sums = near.groupBy("_source", F.col("_bucket").alias("key")).agg(F.sum("_size").alias("words"))
    fine = _edge(sums, first.drop("key"))
    return scratch.save(fine.select("source", "source_size", "target", "epochs", "quota", F.coalesce("key", F.lit(BUCKETS)).alias("edge_bucket"), F.col("before").alias("edge_before")), "plan")


def _decide(placed: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds source_size, target, epochs and extra to placed rows, with no row left out."""
    none = F.lit(0).cast("long")
    both = placed.join(plan, F.col("_source").eqNullSafe(F.col("source")))
    away = both.where("_bucket <> edge_bucket").withColumn("extra", F.when(F.col("_bucket") < F.col("edge_bucket"), F.col("_size")).otherwise(none))
    within = Window.partitionBy("_source").orderBy("_place", "_size").rowsBetween(Window.unboundedPreceding, -1)
    at_edge = both.where("_bucket = edge_bucket").withColumn("start", F.col("edge_before") + F.coalesce(F.sum("_size").over(within), none))
    at_edge = at_edge.withColumn("extra", F.greatest(none, F.least(F.col("_size"), F.col("quota") - F.col("start")))).drop("start")
    return away.unionByName(at_edge)


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """How many words the mix takes from each document.

    Returns one row per input row: id_col, size, source_size, target (its source's), taken (repeats counted), epochs
    (whole repetitions) and extra (words of the fractional one). taken = epochs * size + extra <= max_epochs * size.

    Null and empty texts have size 0 and are taken for 0 words. A null source is a source of its own, last in order.
    Repeated rows are rows like others: equal (id, text) rows are exchangeable, so it doesn't matter which of them is
    cut. A null id hashes like any value. If all texts are empty, all targets are 0. An empty table gives no rows.
    Other columns play no part.
    """
    scratch = Scratch(df.sparkSession, "mixing")
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("origin"))
    placed = scratch.save(_placed(docs, "id", "text", "origin", seed).select("id", "_source", "_size", "_place", "_bucket"), "placed")
    done = _decide(placed, _plan(placed, scratch, max_epochs))
    return done.select(F.col("id").alias(id_col), F.col("_size").alias("size"), "source_size", "target", (F.col("epochs") * F.col("_size") + F.col("extra")).alias("taken"), "epochs", "extra")


def mixed_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself: every document as often as mix_sources takes it, with the columns of df (any names).

    A fractional repetition is the text up to the end of its `extra`-th word, with the white space it has. Documents that
    the mix takes for no words go, empty ones among them. Decisions are made on the rows themselves; nothing is joined by
    id.
    """
    scratch = Scratch(df.sparkSession, "mixing-texts")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(source_col).alias("_origin"))
    placed = _placed(rows, "_id", "_text", "_origin", seed).drop("_id", "_origin")
    slim = scratch.save(placed.select("_source", "_bucket", "_size"), "placed")
    done = _decide(placed, _plan(slim, scratch, max_epochs))
    copies = F.when(F.col("_size") > 0, F.col("epochs") + F.when(F.col("extra") > 0, 1).otherwise(0)).otherwise(0)
    done = done.where(copies > 0).withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
    partial = (F.col("_copy") == F.col("epochs")) & (F.col("extra") < F.col("_size"))
    # A word with the white space before it, as often as words are taken: joined they are the text's beginning as it stands.
    spaced = F.regexp_extract_all(blank(F.col("_text")), F.lit(f"[{SPACE_CLASS}]*{WORD_PATTERN}"), F.lit(0))
    head = F.array_join(F.slice(spaced, 1, F.col("extra").cast("int")), "")
    return done.select(*[(F.when(partial, head).otherwise(F.col("_text")).alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c)) for c in df.columns])


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mix_sources over all rows and whole texts of documents."""
    return mix_sources(read_table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+'))::BIGINT AS size,
    ('0x' || substr(md5('17/' || coalesce(doc_id::VARCHAR, '') || '/' || coalesce(text, '')), 1, 15))::BIGINT AS place FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight, 3 * source_size AS clamp FROM s),
l AS (
  SELECT *, row_number() OVER o AS turn, (sum(source_size) OVER () - coalesce(sum(clamp) OVER p, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER p, 0)) AS level FROM w
  WINDOW o AS (ORDER BY clamp / weight, source NULLS LAST), p AS (ORDER BY clamp / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, CASE WHEN source_size = 0 THEN 0.0::DOUBLE ELSE least(clamp::DOUBLE, coalesce((SELECT min_by(level, turn) FROM l WHERE level * weight <= clamp) * weight, clamp::DOUBLE)) END AS target FROM l),
e AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least(floor(target / source_size), 3)::BIGINT END AS epochs FROM t),
q AS (SELECT *, round(target - epochs * source_size)::BIGINT AS quota FROM e),
b AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM d),
x AS (SELECT doc_id, size, source_size, target, epochs, greatest(0, least(size, quota - before)) AS extra FROM b JOIN q ON b.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target, epochs * size + extra AS taken, epochs, extra FROM x
"""
