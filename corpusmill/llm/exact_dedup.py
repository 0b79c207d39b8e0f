"""Exact dedup with counting quotient filters.

Each partition builds a counting quotient filter over the 64-bit fingerprints of its normalised texts. Filters are cut
into blocks by the top fingerprint bits; the filters of a block merge losslessly by their sorted remainders, counts
added. Fingerprints whose merged count exceeds one route their documents to byte verification by a semi-join (which
shuffles all texts once if the repeats are too many to broadcast): only those texts are grouped, by the normalised text
itself, so a fingerprint collision never joins unequal texts.

A copied text may make up a third of all rows: a partition's filter holds it once, the grouping by text is partly
aggregated before its shuffle, and the joins that hand the decision back to the documents are outer joins whose large
side adaptive execution can split.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import SPACES, Scratch, blank, power_of_two, read_table

#: Distinct fingerprints that one block of merged filters holds on average; 8 MB of remainders at most.
BLOCK_ROWS = 500_000
#: Fingerprints a partition gathers before it emits its filters, so that its memory stays bounded.
BUFFER_ROWS = 2_000_000
_HEADER = struct.Struct("<BBQQ")  # quotient bits, remainder bytes, entries, counters above one


class CountingQuotientFilter:
    """Sorted fingerprints of `bits` bits as runs of remainders under their quotients, with counters for repeats.

    `runs[q]` is the number of remainders under quotient q (0: the slot is unoccupied), remainders lie in order, and
    only entries seen more than once carry a counter. The fingerprint is quotient and remainder side by side, so nothing
    is lost: decode(encode(x)) == x and merging gives what one filter over all rows would hold.
    """

    def __init__(self, fingerprints: np.ndarray, counts: np.ndarray, bits: int):
        self.fingerprints, self.counts, self.bits = fingerprints, counts, bits

    @classmethod
    def build(cls, fingerprints: np.ndarray, bits: int) -> CountingQuotientFilter:
        values, counts = np.unique(fingerprints.astype(np.uint64), return_counts=True)
        return cls(values, counts.astype(np.int64), bits)

    def encode(self) -> bytes:
        n = len(self.fingerprints)
        q_bits = min(max(int(n).bit_length() - 1, 0), 24, self.bits)
        r_bits = self.bits - q_bits
        quotients = (self.fingerprints >> np.uint64(r_bits)) if r_bits < 64 else np.zeros(n, np.uint64)
        runs = np.bincount(quotients.astype(np.int64), minlength=1 << q_bits).astype("<u4")
        r_bytes = (r_bits + 7) // 8
        remainders = (self.fingerprints & np.uint64((1 << r_bits) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, :r_bytes]
        repeated = np.flatnonzero(self.counts > 1)
        return b"".join(
            (
                _HEADER.pack(q_bits, r_bytes, n, len(repeated)),
                runs.tobytes(),
                np.ascontiguousarray(remainders).tobytes(),
                repeated.astype("<u4").tobytes(),
                self.counts[repeated].astype("<i8").tobytes(),
            )
        )

    @classmethod
    def decode(cls, data: bytes, bits: int) -> CountingQuotientFilter:
        q_bits, r_bytes, n, more = _HEADER.unpack_from(data)
        at = _HEADER.size
        runs = np.frombuffer(data, "<u4", 1 << q_bits, at)
        at += runs.nbytes
        padded = np.zeros((n, 8), np.uint8)
        padded[:, :r_bytes] = np.frombuffer(data, np.uint8, n * r_bytes, at).reshape(n, r_bytes)
        at += n * r_bytes
        where = np.frombuffer(data, "<u4", more, at)
        at += where.nbytes
        counts = np.ones(n, np.int64)
        counts[where] = np.frombuffer(data, "<i8", more, at)
        quotients = np.repeat(np.arange(1 << q_bits, dtype=np.uint64), runs)
        r_bits = bits - q_bits
        high = (quotients << np.uint64(r_bits)) if r_bits < 64 else np.zeros(n, np.uint64)
        return cls(high | padded.reshape(-1).view("<u8").astype(np.uint64), counts, bits)

    @classmethod
    def merge(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """One filter over all rows: the sorted remainders fall together and their counters add up."""
        bits = filters[0].bits
        values = np.concatenate([f.fingerprints for f in filters])
        counts = np.concatenate([f.counts for f in filters])
        order = np.argsort(values, kind="stable")
        values, counts = values[order], counts[order]
        first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
        return cls(values[first], np.add.reduceat(counts, first) if len(first) else counts, bits)


def _partition_filters(block_bits: int):
    """Fingerprints of a partition -> (block, filter) rows."""

    def emit(parts: list[np.ndarray]) -> pa.RecordBatch:
        values = np.sort(np.concatenate(parts))
        blocks = (values >> np.uint64(64 - block_bits)).astype(np.int64) if block_bits else np.zeros(len(values), np.int64)
        low = values & np.uint64((1 << (64 - block_bits)) - 1)
        cuts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1], True])
        rows = [(int(blocks[a]), CountingQuotientFilter.build(low[a:b], 64 - block_bits).encode()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["block", "filter"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            if batch.num_rows:
                parts.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64).copy())
                held += batch.num_rows
            if held >= BUFFER_ROWS:
                yield emit(parts)
                parts, held = [], 0
        if parts:
            yield emit(parts)

    return run


def _merged_repeats(block_bits: int):
    """All filters of one block -> the fingerprints counted more than once."""

    def run(table: pa.Table) -> pa.Table:
        bits = 64 - block_bits
        block = np.uint64(table.column("block")[0].as_py())
        merged = CountingQuotientFilter.merge([CountingQuotientFilter.decode(x.as_py(), bits) for x in table.column("filter")])
        again = merged.counts > 1
        values = merged.fingerprints[again] | ((block << np.uint64(bits)) if block_bits else np.uint64(0))
        return pa.table({"fp": pa.array(values.view(np.int64), pa.int64()), "n": pa.array(merged.counts[again], pa.int64())})

    return run


def repeated_fingerprints(fingerprints: DataFrame, rows: int) -> DataFrame:
    """fingerprints: one long column. Returns (fp, n) of those that occur more than once; n is exact."""
    block_bits = power_of_two(max(1, rows / BLOCK_ROWS)).bit_length() - 1
    filters = fingerprints.mapInArrow(_partition_filters(block_bits), "block long, filter binary")
    return filters.groupBy("block").applyInArrow(_merged_repeats(block_bits), "fp long, n long")


def without_space(text: Column) -> Column:
    """text without the white space of the contract. Plain replacement works on bytes and makes no Java strings, of which a
    regular expression makes several for each text."""
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group documents whose texts are equal once white space [\\x20\\x09-\\x0D] is deleted.

    Of equal texts the row with the most code points in its original text stays, then the smallest id. Returns one row
    per input row: id_col, keep_id, group_size (long), kept (boolean), text_sha256 (hex of the normalised text).

    Null texts count as empty, and all empty texts are one group. Repeated rows (same id, same text) are members of
    their group like any other row; all rows that carry the keeping id and its length say kept. Ids may be of any type
    that has an order; a null id is larger than every other id and keeps its group only if no other row can. An empty
    table gives an empty result. Columns other than the two named play no part, so their names cannot clash.
    """
    scratch = Scratch(df.sparkSession, "exact-dedup")
    text = blank(F.col(text_col))
    docs = df.select(F.col(id_col).alias("id"), F.length(text).cast("long").alias("code_points"), without_space(text).alias("norm"))
    docs = docs.withColumn("fp", F.xxhash64("norm"))
    digests = scratch.save(docs.select("id", "code_points", "fp", F.sha2("norm", 256).alias("sha")), "digests")
    repeats = scratch.save(repeated_fingerprints(digests.select("fp"), digests.count()), "repeats", narrow=True)
    routed = docs.select("fp", "norm", "code_points", "id").join(repeats.select("fp"), "fp", "left_semi")
    first = F.min(F.struct((-F.col("code_points")).alias("fewer_points"), F.col("id").isNull().alias("no_id"), "id"))
    groups = routed.groupBy("fp", "norm").agg(F.count("*").alias("group_size"), first.alias("first"))
    groups = groups.where("group_size > 1").select("fp", F.sha2("norm", 256).alias("sha"), "group_size", (-F.col("first.fewer_points")).alias("keep_points"), F.col("first.id").alias("group_keep_id"))
    groups = scratch.save(groups, "groups", narrow=True)
    scratch.drop(repeats)
    joined = digests.join(groups, ["fp", "sha"], "left")
    grouped = F.col("group_size").isNotNull()
    keep = F.when(grouped, F.col("group_keep_id")).otherwise(F.col("id"))
    return joined.select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (~grouped | (F.col("id").eqNullSafe(F.col("group_keep_id")) & (F.col("code_points") == F.col("keep_points")))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """exact_dedup over all rows and whole texts of documents."""
    return exact_dedup(read_table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[ \t-\r]+', '', 'g') AS norm FROM documents),
w AS (
  SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM w
"""
