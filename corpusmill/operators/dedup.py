"""Exact and near duplicates within a source, with the first document in key order staying."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.columns import spaced, strip_text, text_or_empty
from corpusmill.operators.tables import Tables
from corpusmill.operators.workers import bound_batches, give_back, joined_batches

PERMUTATIONS = 128
#: Bands and rows a band for the similarity threshold 0.7: they minimise the areas of false positives and false negatives.
BANDS, ROWS = 14, 9
SHINGLE = 5


def normalised(text: Column) -> Column:
    """White space collapsed, stripped, lower case: what duplicates are compared by."""
    return F.lower(strip_text(spaced(text)))


def exact_marks(df: DataFrame, key: str = "doc_id", source: str = "source", text_col: str = "text") -> DataFrame:
    """(source, key, text_hash, is_duplicate): per source and normalised text the smallest key is no duplicate.

    Texts are read and hashed once, and the hashes stored. The survivor is a minimum, found by an aggregate that starts before
    the shuffle, and only texts that repeat are kept and stored. The join back is between two plain exchanges, so adaptive
    execution can split a hot text.
    """
    hashed = Tables(df.sparkSession, "exact").save(df.select(source, key, F.sha2(normalised(text_or_empty(text_col)), 256).alias("text_hash")))
    first = hashed.groupBy(source, "text_hash").agg(F.min(key).alias("first_key"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = Tables(df.sparkSession, "exact").save(first)
    joined = hashed.alias("h").join(first.alias("f"), (F.col("h.text_hash") == F.col("f.text_hash")) & F.col(f"h.{source}").eqNullSafe(F.col(f"f.{source}")), "left")
    return joined.select(F.col(f"h.{source}").alias(source), F.col(f"h.{key}").alias(key), F.col("h.text_hash").alias("text_hash"), F.coalesce(F.col(f"h.{key}") != F.col("first_key"), F.lit(False)).alias("is_duplicate"))


def _without(df: DataFrame, gone: DataFrame, key: str, source: str) -> DataFrame:
    """Rows of df that are not in gone, by source and key."""
    gone = gone.select(F.col(source).alias("_s"), F.col(key).alias("_k"))
    return df.join(gone, F.col(source).eqNullSafe(F.col("_s")) & (F.col(key) == F.col("_k")), "left_anti")


def exact_dedup(df: DataFrame, key: str = "doc_id", source: str = "source", text_col: str = "text") -> DataFrame:
    """Rows of df that are no duplicate of an earlier one of their source."""
    return _without(df, exact_marks(df, key, source, text_col).where("is_duplicate"), key, source)


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(1)
    return rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(text: str) -> np.ndarray:
    """Distinct hashes of the character 5-grams of a normalised text; a shorter text is one shingle."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    width = min(SHINGLE, max(len(points), 1))
    n = max(len(points) - width + 1, 1)
    h = np.full(n, np.uint64(width))
    for k in range(width if len(points) else 0):
        h = h * np.uint64(0x100000001B3) + points[k : k + n]
    return np.unique(_mixed(h))


def _keyed(low: np.ndarray) -> np.ndarray:
    """Band hashes of signatures: the last axis goes from permutations to bands."""
    rows = low[..., : BANDS * ROWS].reshape(*low.shape[:-1], BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:-1])
    for k in range(ROWS):
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[..., k])
    return key.view(np.int64)


def band_hashes(text: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash for each band of the text's MinHash signature."""
    low = np.full(PERMUTATIONS, np.uint64(0xFFFFFFFFFFFFFFFF))
    shingles = shingle_hashes(text)
    for at in range(0, len(shingles), 2048):
        low = np.minimum(low, _mixed(shingles[at : at + 2048, None] * a + b).min(axis=0))
    return _keyed(low)


#: Characters whose shingles are hashed together, about; numbers hashed in one call; the share of hashes that minima are looked for in first.
TOGETHER, BLOCK, SHARE = 1 << 20, 1 << 14, 64


def _permuted(x: np.ndarray, a: np.uint64, b: np.uint64, out: np.ndarray, spare: np.ndarray) -> None:
    """_mixed(x * a + b) into out, in blocks that stay in a core's cache."""
    shift = np.uint64(33)
    for at in range(0, len(x), BLOCK):
        o = out[at : at + BLOCK]
        t = spare[: len(o)]
        np.multiply(x[at : at + BLOCK], a, out=o)
        np.add(o, b, out=o)
        for factor in (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), None):
            np.right_shift(o, shift, out=t)
            np.bitwise_xor(o, t, out=o)
            if factor is not None:
                np.multiply(o, factor, out=o)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _signatures(texts: list[str], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """MinHash minima of the banded permutations for texts of SHINGLE characters at least, the same that band_hashes takes.

    A shingle that many of the texts share is hashed once for all. A text's minimum is looked for among the smallest hashes
    first, through the list of each shingle's texts; only texts that have none of those go through all of their own.
    """
    sizes = np.array([len(t) - SHINGLE + 1 for t in texts])
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    h = np.full(len(points) - SHINGLE + 1, np.uint64(SHINGLE))
    for k in range(SHINGLE):
        h *= np.uint64(0x100000001B3)
        h += points[k : k + len(h)]
    starts = np.cumsum(sizes + SHINGLE - 1) - (sizes + SHINGLE - 1)
    across = np.ones(len(h), bool)
    across[(starts[1:, None] - np.arange(1, SHINGLE)).ravel()] = False  # shingles over the border of two texts
    h = h[across]
    order = np.argsort(h)
    h = h[order]
    new = np.ones(len(h), bool)
    np.not_equal(h[1:], h[:-1], out=new[1:])
    first = np.flatnonzero(new)  # of each distinct shingle, among its sorted places
    often = np.diff(first, append=len(h))
    inverse = np.empty(len(h), np.int32)
    inverse[order] = np.cumsum(new) - 1
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)[order]
    begins = np.cumsum(sizes) - sizes
    distinct = _mixed(h[first])
    del h, order, new, points, across
    value, spare, most = np.empty_like(distinct), np.empty(BLOCK, np.uint64), np.uint64(0xFFFFFFFFFFFFFFFF)
    low = np.full((BANDS * ROWS, len(texts)), most)
    for i, mine in enumerate(low):
        _permuted(distinct, a[i], b[i], value, spare)
        small = np.flatnonzero(value < np.uint64((1 << 64) // SHARE))
        small = small[np.argsort(value[small])[::-1]]
        mine[owner[_ranges(first[small], often[small])]] = np.repeat(value[small], often[small])  # of several, the last one stays: the least
        left = np.flatnonzero(mine == most)
        if len(left):
            own = value[inverse[_ranges(begins[left], sizes[left])]]
            mine[left] = np.minimum.reduceat(own, np.cumsum(sizes[left]) - sizes[left])
    return low.T


def bands_of(texts: list[str], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """band_hashes of each text, a row a text, with the work of shared shingles done once for about TOGETHER characters."""
    out = np.empty((len(texts), BANDS), np.int64)
    pieces, held = [], 0

    def done() -> None:
        low = _signatures([p for _, p in pieces], a, b)
        of = np.array([k for k, _ in pieces])
        heads = np.flatnonzero(np.diff(of, prepend=-1))
        whole[of[heads]] = np.minimum(whole[of[heads]], np.minimum.reduceat(low, heads, axis=0))

    whole = np.full((len(texts), BANDS * ROWS), np.uint64(0xFFFFFFFFFFFFFFFF))
    for k, text in enumerate(texts):
        if len(text) < SHINGLE:
            out[k] = band_hashes(text, a, b)
            continue
        for at in range(0, len(text) - SHINGLE + 1, TOGETHER):  # a text of many characters goes piece by piece
            pieces.append((k, text[at : at + TOGETHER + SHINGLE - 1]))
            held += len(pieces[-1][1])
            if held >= TOGETHER:
                done()
                pieces, held = [], 0
    if pieces:
        done()
    long = np.array([len(t) >= SHINGLE for t in texts], bool)
    out[long] = _keyed(whole[long])
    return out


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = _coefficients()
    for batch in joined_batches(batches, "norm", TOGETHER):
        bands = bands_of(batch.column("norm").to_pylist(), a, b)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(bands) + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("source"), batch.column("ord"), lists], ["source", "ord", "bands"])
    give_back()


def near_dropped(df: DataFrame, key: str = "doc_id", source: str = "source", text_col: str = "text") -> DataFrame:
    """(source, key) of the documents that go by the greedy rule: in key order within a source, a document is dropped if one of
    its bands collides with a document kept before it. There is no similarity check, and dropped documents drop nobody.

    Documents are decided in rounds over the buckets of those still open. The first open document of a bucket is a minimum;
    one that is first in all its buckets is kept, and what shares a bucket with it goes. Documents kept in earlier rounds
    play no part any more: all that they drop has gone. The first open document is always decided, so rounds end, and each
    works on the rows of open documents alone, whatever the size of a bucket. What goes is written by round.
    """
    tables = Tables(df.sparkSession, "near")
    bound_batches(df.sparkSession)
    docs = df.select(F.col(source).alias("source"), F.col(key).alias("ord"), normalised(text_or_empty(text_col)).alias("norm"))
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    banded = docs.mapInArrow(_banded, f"source {kinds['source']}, ord {kinds['ord']}, bands array<long>")
    # A bucket is a source and a band's hash (which the band is part of); a null source is one of its own.
    rows = tables.save(banded.select("source", "ord", F.explode("bands").alias("hash")).withColumn("bucket", F.xxhash64(F.coalesce(F.col("source").cast("string"), F.lit("")), F.col("source").isNull(), "hash")))
    # Joins by bucket are between stored tables, so that a bucket with very many documents can be split.
    shared = tables.save(rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select("bucket"))
    open_ = tables.save(rows.join(shared, "bucket").select("source", "ord", "bucket"))
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source")) & (F.col(f"{a}.ord") == F.col(f"{b}.ord"))
    gone, turn = tables.folder(), 0
    while not open_.isEmpty():
        first = tables.save(open_.groupBy("bucket").agg(F.min("ord").alias("first")))
        seen = open_.join(first, "bucket").groupBy("source", "ord").agg(F.min(F.col("ord") == F.col("first")).alias("leads"))
        kept = tables.save(seen.where("leads").select("source", "ord"))
        heads = tables.save(open_.alias("o").join(kept.alias("k"), same("o", "k"), "left_semi").select("bucket", F.col("ord").alias("head")))
        behind = open_.join(heads, "bucket").where("ord > head").select("source", "ord").distinct()
        behind.write.parquet(f"{gone}/turn={turn}")
        dropped = df.sparkSession.read.schema(behind.schema).parquet(f"{gone}/turn={turn}")
        decided = kept.unionByName(dropped)
        open_, turn = tables.save(open_.alias("o").join(decided.alias("d"), same("o", "d"), "left_anti")), turn + 1
    if not turn:
        return docs.select(F.col("source").alias(source), F.col("ord").alias(key)).limit(0)
    dropped = df.sparkSession.read.schema(docs.select("source", "ord").schema).parquet(f"{gone}/turn=*")
    return dropped.select(F.col("source").alias(source), F.col("ord").alias(key))


def near_marks(df: DataFrame, key: str = "doc_id", source: str = "source", text_col: str = "text") -> DataFrame:
    """(source, key, is_near_duplicate): whether near_dropped has the document."""
    gone = near_dropped(df, key, source, text_col).select(F.col(source).alias("gs"), F.col(key).alias("go"))
    out = df.select(source, key).join(gone, F.col(source).eqNullSafe(F.col("gs")) & (F.col(key) == F.col("go")), "left")
    return out.select(source, key, F.col("go").isNotNull().alias("is_near_duplicate"))


def dedup(df: DataFrame, key: str = "doc_id", source: str = "source", text_col: str = "text", near: bool = True) -> DataFrame:
    """Rows that stay after exact and, if asked, near dedup within each source."""
    out = exact_dedup(df, key, source, text_col)
    if not near:
        return out
    out = Tables(df.sparkSession, "exact").save(out)
    return _without(out, near_dropped(out, key, source, text_col), key, source)


def dedup_stats(df: DataFrame, key: str = "doc_id", source: str = "source", text_col: str = "text", near: bool = True) -> DataFrame:
    """total, exact_dups, near_dups and kept by source."""
    marks = Tables(df.sparkSession, "exact").save(exact_marks(df, key, source, text_col).select(source, key, "is_duplicate"))
    exact = marks.groupBy(source).agg(F.count("*").alias("total"), F.count_if("is_duplicate").alias("exact_dups"))
    if not near:
        return exact.withColumn("near_dups", F.lit(0).cast("long")).withColumn("kept", F.col("total") - F.col("exact_dups"))
    unique = _without(df.select(key, source, text_col), marks.where("is_duplicate"), key, source)
    found = near_marks(unique, key, source, text_col).groupBy(F.col(source).alias("_s")).agg(F.count_if("is_near_duplicate").alias("near_dups"))
    joined = exact.join(found, F.col(source).eqNullSafe(F.col("_s")), "left").drop("_s").withColumn("near_dups", F.coalesce("near_dups", F.lit(0).cast("long")))
    return joined.withColumn("kept", F.col("total") - F.col("exact_dups") - F.col("near_dups"))
