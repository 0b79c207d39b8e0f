"""Approximate nearest neighbours by inner product, with a permutation index.

A bounded seeded sample of vectors serves as pivots. Every vector is represented by its ordered nearest pivots (a
prefix of PREFIX of them). Vectors lie in blocks, and each block holds inverted files: for each pivot the vectors that
have it in their prefix, with its place there. A query reads only the files of its own nearest pivots; each shared pivot
brings a vector's footrule distance down by 2 * (PREFIX + 1 - the later of both places), so summing that over files ranks a
block by footrule distance. The best ranked are compared exactly, in double precision on the original vectors, and the
nearest of all blocks are merged.

Inner products are turned into distances by one added coordinate, sqrt(M^2 - |x|^2) with M the largest norm (0 for
queries), so that pivots near a query are those with the largest inner product.

Blocks of queries meet blocks of vectors through an equi-join on block numbers; pair counts are blocks, not rows. Each
pair is one small matrix problem, and the result of a pair is at most `k` rows a query. A query's rows are cut to the best
`k` in each task before they are shuffled, and again behind the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import Scratch, read_table

#: Pivots: a bounded sample, in the order of a seeded hash.
PIVOTS = 256
PREFIX = 64
#: Vectors in a block of the index, and queries in a block of queries.
BLOCK = 8192
QUERIES = 512
#: Share of a block, and vectors at least, that footrule ranking hands to exact comparison.
RERANK, RERANK_LEAST = 0.12, 640
SEED = 31


def valid(vector: str) -> F.Column:
    """Vectors that are null, zero, or hold a null, infinite or undefined component take no part."""
    x = F.col(vector)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return x.isNotNull() & F.coalesce(fine, F.lit(False)) & F.coalesce(F.exists(x, lambda v: v != 0), F.lit(False))


def prefixes(vectors: np.ndarray, pivots: np.ndarray, largest: float, is_query: bool) -> np.ndarray:
    """The nearest pivots of each row, nearest first: (n, min(PREFIX, pivots)) pivot numbers."""
    extra = np.zeros(len(vectors)) if is_query else np.sqrt(np.maximum(largest**2 - (vectors**2).sum(axis=1), 0))
    own = np.sqrt(np.maximum(largest**2 - (pivots**2).sum(axis=1), 0))
    near = vectors @ pivots.T + extra[:, None] * own[None, :]
    near -= 0.5 * ((pivots**2).sum(axis=1) + own**2)[None, :]
    width = min(PREFIX, len(pivots))
    return np.argsort(-near, axis=1, kind="stable")[:, :width].astype(np.int32)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _block_rows(pivots: np.ndarray, scale: float, largest: float, is_query: bool):
    """A group of vectors -> one packed row: ids, original vectors, and prefixes (queries) or inverted files (index)."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        ids = table.column("vec_id").to_numpy().astype("<i8")
        vectors = _matrix(table.column("x").combine_chunks())
        near = prefixes(vectors / scale, pivots, largest, is_query)
        if is_query:
            files, first = near.astype("<i4"), np.zeros(0, "<i4")
        else:
            # Inverted files: entries sorted by pivot; an entry is the vector's row and the pivot's place.
            order = np.argsort(near.reshape(-1), kind="stable")
            files = np.stack([order // near.shape[1], order % near.shape[1]]).astype("<i2" if len(ids) < 1 << 15 else "<i4")
            first = np.searchsorted(near.reshape(-1)[order], np.arange(len(pivots) + 1)).astype("<i4")
        row = {"block": [int(table.column("block")[0].as_py())], "ids": [ids.tobytes()], "vectors": [vectors.astype("<f8").tobytes()], "files": [files.tobytes()], "first": [first.tobytes()]}
        return pa.table(row, schema=pa.schema([("block", pa.int64()), *[(c, pa.binary()) for c in ("ids", "vectors", "files", "first")]]))

    return run


def search_block(q_ids, q_vectors, q_near, ids, vectors, files, first, k: int, rerank: float):
    """Yields (query id, ids, scores) with each query's k best of one block."""
    n, width = len(ids), q_near.shape[1]
    most = min(n, max(RERANK_LEAST, int(np.ceil(n * rerank)), k + 1))
    place = np.arange(n, dtype=np.float64) / n  # among equal footrule distances the smaller id comes first
    for q, own in enumerate(q_near):
        score = np.zeros(n)
        for i, pivot in enumerate(own):
            a, b = first[pivot], first[pivot + 1]
            score[files[0, a:b]] += width - np.maximum(files[1, a:b], i)
        at = np.arange(n) if most == n else np.argpartition(place - score, most - 1)[:most]
        at = at[ids[at] != q_ids[q]]
        exact = (vectors[at] * q_vectors[q]).sum(axis=1)  # row by row: equal vectors get equal scores in every block
        best = np.lexsort((ids[at], -exact))[:k]
        yield q_ids[q], ids[at[best]], exact[best]


def _search(k: int, width: int, rerank: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, ids = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["ids"], "<i8")
                q_vectors = np.frombuffer(row["q_vectors"], "<f8").reshape(len(q_ids), -1)
                vectors = np.frombuffer(row["vectors"], "<f8").reshape(len(ids), -1)
                found = list(search_block(q_ids, q_vectors, np.frombuffer(row["q_near"], "<i4").reshape(len(q_ids), width), ids, vectors, np.frombuffer(row["files"], "<i2" if len(ids) < 1 << 15 else "<i4").reshape(2, -1), np.frombuffer(row["first"], "<i4"), k, rerank))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(f[0]) for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.int64())), pa.array([f[2] for f in found], pa.list_(pa.float64()))], ["query_id", "ids", "scores"]
                )

    return run


def nearest(df: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", rerank: float = RERANK) -> DataFrame:
    """Each query's k nearest rows of df by inner product: query_id, rank (from 1), vec_id, score (double).

    queries: rows with the same two columns. A row never answers a query with its own id. Ties go to the smaller id.
    Vectors that are null, zero, or hold null or non-finite components take no part, nor do vectors whose length is not
    the most frequent one, nor null ids. Rows that repeat an id answer as often as they occur. Fewer than k candidates
    are all returned; empty tables give no rows. Other columns play no part. Pivots are found on scaled vectors, so that
    finite components of any size are fine; an inner product beyond the range of doubles is an infinite score (or, where
    infinities of both signs meet, none: such rows come last), and equal infinite scores tie.
    """
    spark, scratch = df.sparkSession, Scratch(df.sparkSession, "ann")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def usable(table):
        rows = table.where(valid(vector_col) & F.col(id_col).isNotNull())
        return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))

    rows = usable(df)
    biggest = F.max(F.array_max(F.transform("x", F.abs)))
    shape = rows.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"), biggest.alias("scale")).orderBy(F.desc("n"), "size").first()
    if shape is None:
        return empty
    size, n, scale = shape["size"], shape["n"], shape["scale"]
    rows = rows.where(F.size("x") == size)
    square = rows.agg(F.max(F.aggregate("x", F.lit(0.0), lambda a, v: a + (v / scale) * (v / scale))).alias("square")).first()["square"]
    largest = float(np.sqrt(square))
    pivots = np.array([r["x"] for r in rows.orderBy(F.xxhash64(F.lit(SEED), "vec_id"), "vec_id").limit(PIVOTS).collect()])  # a bounded sample
    pivots = np.unique(pivots / scale, axis=0)
    packed = "block long, ids binary, vectors binary, files binary, first binary"
    blocks = max(1, -(-n // BLOCK))
    block_of = F.pmod(F.xxhash64(F.lit(SEED + 1), "vec_id"), F.lit(blocks))
    index = scratch.save(rows.withColumn("block", block_of).groupBy("block").applyInArrow(_block_rows(pivots, scale, largest, False), packed), "index")
    asked = usable(queries).where(F.size("x") == size)
    groups = max(1, -(-asked.count() // QUERIES))
    group_of = F.pmod(F.xxhash64(F.lit(SEED + 2), "vec_id"), F.lit(groups))
    asked = asked.withColumn("block", group_of).groupBy("block").applyInArrow(_block_rows(pivots, scale, largest, True), packed)
    asked = asked.select(F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), F.col("files").alias("q_near"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    pairs = asked.repartition(max(groups * blocks, 1), "block", F.xxhash64("q_ids")).join(index, "block")
    found = pairs.select("q_ids", "q_vectors", "q_near", "ids", "vectors", "files", "first").mapInArrow(_search(k, min(PREFIX, len(pivots)), rerank), "query_id long, ids array<long>, scores array<double>")
    each = found.select("query_id", F.explode(F.arrays_zip(F.col("ids").alias("id"), F.col("scores").alias("score"))).alias("one"))
    each = each.select("query_id", F.col("one.id").alias("vec_id"), F.col("one.score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(F.when(F.isnan("score"), None).otherwise(F.col("score"))), "vec_id"))
    return each.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nearest over all rows of embeddings; queries are the rows whose vec_id is divisible by 20."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))
