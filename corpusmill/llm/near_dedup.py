"""MinHash near-dedup: one-permutation hashing, optimal densification, banded buckets, a star and then all open pairs.

1. One pass over whole texts hashes the distinct word shingles once; the 64-bit hash space is cut into BINS bins and the
   least hash of each bin is the signature. Empty bins take the value of a non-empty bin that a universal hash of (bin,
   attempt) picks, so that signatures of small sets agree with probability equal to their similarity too.
2. Documents with equal shingle sets form a class; only its representative (smallest id) goes on. A text copied into a
   third of all rows is one representative, found by an aggregate that starts before the shuffle.
3. Signatures are cut into BANDS bands; each band is a bucket key. In every bucket each member is compared with one hub
   first, the member that collides most in all: one pair a member.
4. A bucket whose members are still in several components stays open. Its largest component is left whole, and each member
   outside of it meets all other members, in blocks, so that no task holds a hot bucket. Pairs are members outside times
   members: a group of copies or near copies that its hub has joined costs nothing, whatever its size, and a link between
   two texts that share a bucket is never lost. A family of texts just below the threshold, which no link joins, costs the
   square of its size in comparisons (not in rows: only pairs that may be links leave a task).
5. A parity sketch of each set, four to eight bits a shingle, bounds the symmetric difference of two sets from below. It
   refuses pairs but never a link; what it lets through is confirmed on full shingle sets: 100 * intersection >=
   threshold * union. Sets are rebuilt from text only for documents that share a bucket; a Bloom filter of those ids, of
   checked size, keeps all other texts out of the second pass (beyond that size a shuffled semi-join does the same).
6. Components come from alternating large-star and small-star steps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import Scratch, giving_back, power_of_two, read_table
from corpusmill.llm.components import connected_components
from corpusmill.llm.kernels import mix64, sequence_hash, shingle_hashes, slices, words

BINS = 128
BANDS = 32
#: Attempts of densification before the next non-empty bin is taken (never needed in practice).
ATTEMPTS = 4096
#: Bits of a parity sketch for each shingle, at least, and 64-bit words of the shortest and the longest sketch.
PARITY_BITS, PARITY_LEAST, PARITY_MOST = 4, 4, 1 << 14
#: Members of an open bucket that one task compares with as many others (on average), and pairs that it looks at together.
BLOCK = 1024
PAIRS = 1 << 16
#: Bits of the Bloom filter that is shared with all executors, at most (8 MB).
BLOOM_BITS = 1 << 26
_PICKS = (mix64(np.arange(ATTEMPTS * BINS, dtype=np.uint64) + np.uint64(0x5DEECE66D)) % np.uint64(BINS)).astype(np.int64).reshape(ATTEMPTS, BINS)


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; texts with fewer words are one shingle, without words none."""
    hashes, first, *_ = words(column)
    grams = shingle_hashes(hashes, width)
    sets = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            own = np.sort(grams[a : b - width + 1])
            sets.append(own[np.r_[True, own[1:] != own[:-1]]])
        elif b > a:
            sets.append(np.array([sequence_hash(hashes[a:b])], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One-permutation signatures (len(sets), BINS) with optimal densification. Sets must not be empty."""
    low = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - (BINS.bit_length() - 1))
    out = np.zeros((len(sets), BINS), np.uint64)
    full = np.zeros((len(sets), BINS), bool)
    shift = np.uint64(64 - (BINS.bit_length() - 1))
    for row, own in enumerate(sets):
        at = np.minimum(np.searchsorted(own, low), len(own) - 1)
        out[row] = own[at]
        full[row] = (own[at] >> shift) == np.arange(BINS)
    rows = np.flatnonzero(~full.all(axis=1))
    values, there = out[rows], full[rows]
    done, filled = there.copy(), values.copy()
    for attempt in range(ATTEMPTS):
        if not len(rows):
            break
        pick = _PICKS[attempt]
        take = ~done & there[:, pick]
        filled[take] = values[:, pick][take]
        done |= take
        if attempt % 8 == 7 or attempt == ATTEMPTS - 1:
            over = done.all(axis=1) | (attempt == ATTEMPTS - 1)
            for k in np.flatnonzero(over & ~done.all(axis=1)):
                have = np.flatnonzero(there[k])
                gaps = np.flatnonzero(~done[k])
                filled[k, gaps] = values[k, have[np.searchsorted(have, gaps) % len(have)]]
            out[rows[over]] = filled[over]
            rows, values, there, done, filled = rows[~over], values[~over], there[~over], done[~over], filled[~over]
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(n, BANDS) bucket keys; the band's number is part of the key."""
    rows = signature.reshape(len(signature), BANDS, BINS // BANDS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for k in range(rows.shape[2]):
        key = mix64(key * np.uint64(0xD6E8FEB86659FD93) + rows[:, :, k])
    return key


def parity(own: np.ndarray) -> bytes:
    """The parity of how many elements fall on each bit. Two sketches differ in no more bits than their sets in elements.
    The length, a power of two, follows the size of the set; folding a longer sketch by halves gives the shorter one."""
    words_ = min(max(power_of_two(PARITY_BITS * len(own) / 64), PARITY_LEAST), PARITY_MOST)
    bits = np.bincount((own >> np.uint64(7)).astype(np.int64) % (64 * words_), minlength=64 * words_) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


class Sketches:
    """Sizes and parity sketches of rows, compared by pairs of row numbers."""

    def __init__(self, n: np.ndarray, sketches: list[bytes]):
        self.n, self.words = n, np.array([len(x) // 8 for x in sketches], np.int64)
        self.tables, self.place = {}, np.zeros(len(sketches), np.int64)
        for size in np.unique(self.words).tolist():
            own = np.flatnonzero(self.words == size)
            self.place[own] = np.arange(len(own))
            self.tables[size] = np.frombuffer(b"".join(sketches[k] for k in own), np.uint64).reshape(-1, size)

    def _rows(self, which: np.ndarray, size: int, want: int) -> np.ndarray:
        rows = self.tables[size][self.place[which]]
        while rows.shape[1] > want:
            half = rows.shape[1] // 2
            rows = rows[:, :half] ^ rows[:, half:]
        return rows

    def close(self, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
        """Which pairs (x[k], y[k]) sizes and sketches allow a link."""
        a, b = self.n[x], self.n[y]
        good = np.minimum(a, b) * 100 >= np.maximum(a, b) * percent
        at = np.flatnonzero(good)
        code = self.words[x[at]] * (2 * PARITY_MOST) + self.words[y[at]]
        for key in np.unique(code).tolist():
            size_x, size_y = divmod(key, 2 * PARITY_MOST)
            own, least = at[code == key], min(size_x, size_y)
            for k in range(0, len(own), step := max(1, (1 << 18) // least)):
                part = own[k : k + step]
                both = self._rows(x[part], size_x, least) ^ self._rows(y[part], size_y, least)
                differ = np.bitwise_count(both).sum(axis=1, dtype=np.int64)
                good[part] = differ * (100 + percent) <= (self.n[x[part]] + self.n[y[part]]) * (100 - percent)
        return good


def open_pairs(group: np.ndarray, left: np.ndarray, major: np.ndarray, tie: np.ndarray, component: np.ndarray, sketches: Sketches, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows in runs of equal group, in each run those with left first: pairs of a left and a right row of a run that are of
    different components and that sizes and sketches allow a link. Two rows outside of the major component meet twice, each
    as left row of the other; the pair counts where the left one has the smaller tie."""
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]][: len(group)])
    sizes = np.diff(np.r_[first, len(group)])
    rows, out = np.flatnonzero(left), [np.zeros((2, 0), np.int64)]
    if not len(rows):
        return out[0][0], out[0][1]
    lefts = np.add.reduceat(left.astype(np.int64), first)
    right_from, counts = np.repeat(first + lefts, sizes)[rows], np.repeat(sizes - lefts, sizes)[rows]
    through, low = np.cumsum(counts), 0
    while low < len(rows):
        high = max(low + 1, int(np.searchsorted(through, (through[low - 1] if low else 0) + PAIRS, "right")))
        own, many = rows[low:high], counts[low:high]
        x = np.repeat(own, many)
        y = np.arange(len(x)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(right_from[low:high], many)
        fits = (component[x] != component[y]) & (major[y] | (tie[x] <= tie[y]))
        x, y = x[fits], y[fits]
        good = sketches.close(x, y, percent)
        out.append(np.stack([x[good], y[good]]))
        low = high
    x, y = np.concatenate(out, axis=1)
    return x, y


def _open_pairs(percent: int):
    """Sorted rows (group_key, is_left, is_major, tie, rep, n, component, parity) -> (u, v) of pairs that may be links.

    A task's rows come in runs, one for each block of a bucket; a run that a batch cuts off waits for the rest of it."""

    def found(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        key, left, major, tie, n = (rows.column(c).to_numpy() for c in ("group_key", "is_left", "is_major", "tie", "n"))
        component = rows.column("component").combine_chunks().dictionary_encode().indices.to_numpy()
        x, y = open_pairs(key, left, major, tie, component, Sketches(n, rows.column("parity").to_pylist()), percent)
        ids = rows.column("rep").combine_chunks()
        return pa.RecordBatch.from_arrays([ids.take(pa.array(x)), ids.take(pa.array(y))], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            if batch.num_rows:
                key = batch.column("group_key").to_numpy()
                cut = int(np.flatnonzero(np.r_[True, key[1:] != key[:-1]])[-1])  # where the last run begins
                if held and (cut or key[0] != held[-1].column("group_key")[-1].as_py()):
                    yield found(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                    held = []
                elif cut:
                    yield found(pa.Table.from_batches([batch.slice(0, cut)]))
                held.append(batch.slice(cut))
        if held:
            yield found(pa.Table.from_batches(held))

    return giving_back(run)


def _near(percent: int):
    """(u, v, n_u, n_v, parity_u, parity_v) -> (u, v) of the pairs that sizes and sketches allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.r_[batch.column("n_u").to_numpy(zero_copy_only=False), batch.column("n_v").to_numpy(zero_copy_only=False)]
            sketches = Sketches(n, batch.column("parity_u").to_pylist() + batch.column("parity_v").to_pylist())
            at = np.arange(batch.num_rows)
            yield batch.select(["u", "v"]).filter(pa.array(sketches.close(at, at + batch.num_rows, percent), pa.bool_()))

    return giving_back(run)


def _sketch(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column("text")):
                part = batch.slice(low, high - low)
                sets = shingle_sets(part.column("text"), width)
                some = [k for k, own in enumerate(sets) if len(own)]
                keys = band_keys(signatures([sets[k] for k in some])).view(np.int64) if some else np.zeros((0, BANDS), np.int64)
                counts = np.zeros(len(sets), np.int32)
                counts[some] = BANDS
                bands = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(keys.reshape(-1)))
                digests = [hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None for own in sets]
                parities = pa.array([parity(own) if len(own) else None for own in sets], pa.binary())
                columns = [part.column("id"), pa.array([len(own) for own in sets], pa.int64()), pa.array(digests, pa.binary()), bands, parities]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "set_key", "bands", "parity"])

    return giving_back(run)


def _bloom_positions(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    h = mix64(hashes.view(np.uint64).copy())
    return [((h + np.uint64(k) * (h >> np.uint64(32) | np.uint64(1))) & np.uint64(bits - 1)).astype(np.int64) for k in range(5)]


def _bloom(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = np.zeros(bits, bool)
        for batch in batches:
            for at in _bloom_positions(batch.column(0).to_numpy(zero_copy_only=False), bits):
                field[at] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(field).tobytes()], pa.binary())], ["field"])

    return giving_back(run)


def _sets_of(width: int, field, bits: int):
    """(id, text, id_hash) -> (id, set) of the rows that the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = np.unpackbits(np.frombuffer(field.value, np.uint8)).astype(bool) if field is not None else None
        for batch in batches:
            if have is not None and batch.num_rows:
                hashes = batch.column("id_hash").to_numpy(zero_copy_only=False)
                batch = batch.filter(pa.array(np.logical_and.reduce([have[at] for at in _bloom_positions(hashes, bits)])))
            for low, high in slices(batch.column("text")):
                part = batch.slice(low, high - low)
                sets = shingle_sets(part.column("text"), width)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([own.tobytes() for own in sets], pa.binary())], ["id", "own"])

    return giving_back(run)


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for k, (a, b) in enumerate(zip(batch.column("own_a"), batch.column("own_b"), strict=True)):
                x, y = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                if len(x):
                    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                    good[k] = 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.select(["u", "v"]).filter(pa.array(good))

    return giving_back(run)


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Link documents whose distinct word shingles have a Jaccard similarity of at least percent / 100.

    Words are runs without white space [\\x20\\x09-\\x0D], A-Z in lower case; shingles have `width` words, and a text with
    fewer words is one shingle. Returns one row per input row: id_col, n_shingles (distinct), component_id (smallest id
    that links reach, itself included), kept (id = component_id).

    Null and empty texts, and texts of white space, have no shingle and no link. Rows with a null id take no part:
    component_id null, kept true. Repeated rows and rows that share an id are one node of the graph and come back as
    often as they came. An empty table gives no rows. Other columns play no part.
    """
    spark, scratch = df.sparkSession, Scratch(df.sparkSession, "near-dedup")
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    sketch = scratch.save(docs.mapInArrow(_sketch(width), f"id {kind}, n long, set_key binary, bands array<long>, parity binary"), "sketch")
    nodes = sketch.where("n > 0 AND id IS NOT NULL")
    classes = scratch.save(nodes.groupBy("set_key").agg(F.min("id").alias("rep"), F.count("*").alias("members"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("parity").alias("parity")), "classes")

    spread = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    # What is joined by bucket is stored first: both sides of a join are then plain exchanges, and adaptive execution can
    # split a bucket that holds a third of all rows.
    shared = scratch.save(spread.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "shared")
    members = scratch.save(spread.join(shared, "bucket"), "members")
    weight = scratch.save(members.groupBy("rep").agg(F.sum("size").alias("weight")), "weight", narrow=True)

    node_ids = members.select(F.xxhash64("rep").alias("h")).distinct()
    bits = power_of_two(12 * max(64, node_ids.count()))
    texts = docs.where("id IS NOT NULL").withColumn("id_hash", F.xxhash64("id"))
    field = None
    if bits <= BLOOM_BITS:
        parts = node_ids.coalesce(8).mapInArrow(_bloom(bits), "field binary").collect()  # at most 8 filters of 8 MB
        joined = np.bitwise_or.reduce([np.frombuffer(r["field"], np.uint8) for r in parts]) if parts else np.zeros(bits // 8, np.uint8)
        field = spark.sparkContext.broadcast(joined.tobytes())
    else:
        texts = texts.join(node_ids.withColumnRenamed("h", "id_hash"), "id_hash", "left_semi")
    sets = scratch.save(texts.mapInArrow(_sets_of(width, field, bits), f"id {kind}, own binary"), "sets")

    parities = classes.select("rep", "n", "parity")

    def near(pairs: DataFrame) -> DataFrame:
        """Pairs (u, v) that their sizes and sketches allow a link."""
        own = parities.select(F.col("rep").alias("u"), F.col("n").alias("n_u"), F.col("parity").alias("parity_u"))
        other = parities.select(F.col("rep").alias("v"), F.col("n").alias("n_v"), F.col("parity").alias("parity_v"))
        joined = pairs.join(own, "u").join(other, "v").select("u", "v", "n_u", "n_v", "parity_u", "parity_v")
        return scratch.save(joined.mapInArrow(_near(percent), f"u {kind}, v {kind}"), "near", narrow=True)

    def confirm(pairs: DataFrame) -> DataFrame:
        """Pairs (u, v) whose full sets are similar enough."""
        own = sets.select(F.col("id").alias("u"), F.col("own").alias("own_a"))
        other = sets.select(F.col("id").alias("v"), F.col("own").alias("own_b"))
        joined = pairs.join(own, "u").join(other, "v").select("u", "v", "own_a", "own_b")
        return scratch.save(joined.mapInArrow(_confirmed(percent), f"u {kind}, v {kind}"), "links", narrow=True)

    busiest = F.max(F.struct("weight", F.xxhash64("rep").alias("tie"), "rep", "n"))
    hubs = members.join(weight, "rep").groupBy("bucket").agg(busiest.alias("hub"))
    hubs = scratch.save(hubs.select("bucket", F.col("hub.rep").alias("hub"), F.col("hub.n").alias("hub_n")), "hubs", narrow=True)
    fits = F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * percent
    starred = members.join(hubs, "bucket").where((F.col("rep") != F.col("hub")) & fits)
    pairs = scratch.save(starred.select(F.col("rep").alias("u"), F.col("hub").alias("v")).distinct(), "pairs", narrow=True)
    close = near(pairs)
    links = confirm(close)
    components = connected_components(links, scratch)
    scratch.drop(weight, shared, hubs, pairs, close, links)

    # Buckets that hold several components stay open. Each member outside of the largest one meets all other members.
    known = components.select(F.col("id").alias("rep"), "component")
    placed = scratch.save(members.select("bucket", "rep").join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep")), "placed")
    held = placed.groupBy("bucket", "component").agg(F.count("*").alias("c"))
    split = held.groupBy("bucket").agg(F.max(F.struct("c", "component")).alias("most"), F.sum("c").alias("size"), F.count("*").alias("components")).where("components > 1")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    split = split.select("bucket", F.col("most.component").alias("major"), blocks(F.col("size") - F.col("most.c")).alias("lefts"), blocks(F.col("size")).alias("rights"))
    split = scratch.save(split, "split", narrow=True)
    open_ = scratch.save(placed.join(split, "bucket").join(parities, "rep"), "open")
    scratch.drop(members, placed, split)
    tie, is_major = F.xxhash64("rep"), F.col("component") == F.col("major")
    place = lambda left, i, j: F.struct(F.lit(left).alias("is_left"), i.alias("i"), j.alias("j"))
    as_left = F.transform(F.sequence(F.lit(0), F.col("rights") - 1), lambda j: place(True, F.pmod(tie, F.col("lefts")).cast("int"), j))
    as_right = F.transform(F.sequence(F.lit(0), F.col("lefts") - 1), lambda i: place(False, i, F.pmod(tie, F.col("rights")).cast("int")))
    dealt = open_.withColumn("x", F.explode(F.when(is_major, as_right).otherwise(F.concat(as_left, as_right))))
    dealt = dealt.select(F.xxhash64("bucket", "x.i", "x.j").alias("group_key"), "x.is_left", is_major.alias("is_major"), tie.alias("tie"), "rep", F.col("n").cast("long").alias("n"), "component", "parity")
    runs = dealt.repartition("group_key").sortWithinPartitions("group_key", F.desc("is_left"))
    fresh = runs.mapInArrow(_open_pairs(percent), f"u {kind}, v {kind}").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    found = confirm(scratch.save(fresh.distinct(), "open-pairs", narrow=True))
    if not found.isEmpty():
        components = connected_components(components.select(F.col("id").alias("u"), F.col("component").alias("v")).unionByName(found), scratch)
    scratch.drop(open_, sets, found)

    known = components.select(F.col("id").alias("rep"), "component")
    joined = classes.select("set_key", "rep", "members").join(known, "rep", "left")
    joined = joined.where("members > 1 OR component IS NOT NULL").select("set_key", F.coalesce("component", "rep").alias("component"))
    out = sketch.select("id", "n", "set_key").join(joined, "set_key", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """near_dedup over all rows and whole texts of documents, with shingles of four words as its contract sets."""
    return near_dedup(read_table(spark, sf_dir, "documents"), width=4, percent=80)


OP5_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t-\r]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS both_have FROM g a JOIN g b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT u, v FROM c JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * both_have >= 80 * (x.n + y.n - both_have)),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r AS (SELECT doc_id, doc_id AS least_id FROM documents UNION SELECT e.v, r.least_id FROM r JOIN e ON r.doc_id = e.u AND r.least_id < e.v),
m AS (SELECT doc_id, min(least_id) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
"""
