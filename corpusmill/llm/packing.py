"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Capacity C is a few thousand tokens and lengths are whole numbers up to C, so the instance is its histogram: at most C
rows, whatever the size of the corpus. The driver solves that histogram, in groups of equal sequences ("patterns" with
multiplicities), and its plan is bounded by C alone:

1. Dominance reduction. For the longest length L left, sets of documents that dominate every other way to fill L's
   sequence are fixed for good: L alone where nothing fits beside it; L with a partner that fills it exactly; L with its
   longest fitting partner where no two documents fit beside L. All documents of a length are fixed at once.
2. The remainder is packed best-fit decreasing: into the fullest open sequence that still takes the document.

Pieces then find their places without meeting in one task: they are numbered within their length by hash bucket
(counts per bucket, prefix sums over buckets, row numbers within one bucket), and a search in the plan turns
(length, number) into (sequence, offset).
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import Scratch, give_back, power_of_two, read_table
from corpusmill.llm.kernels import slices, words

CAPACITY = 2048
END_ID = 0
#: Pieces that one hash bucket of a length holds on average while pieces are numbered.
BUCKET_ROWS = 500
#: Words and ids that a Python worker remembers (about 100 MB); it forgets all of them when either is reached.
CACHE_WORDS, CACHE_IDS = 2_000_000, 16_000_000
#: Words and ids that it still remembers when a task is over, at most (12 MB), and slots of an empty table.
REST_WORDS, REST_IDS, LEAST_SLOTS = 1 << 18, 1 << 20, 1 << 12


class WordTokens:
    """Ids of whole texts by a tokenizer whose ids of a text are those of its white-space separated words in turn.

    That holds for tokenizers that drop white space and never merge across it; other white space than the six characters
    that texts are cut at here stays within words and is the tokenizer's to drop. Words repeat: an open-addressing table
    of 64-bit word hashes finds the ids of known words for a whole slice of texts at a time, and the tokenizer only sees
    words that are new to this worker. The table grows with its words, and only the words learnt first, the frequent ones
    among them, outlast a task: workers go on to other operators, beside the JVM of their executor.
    """

    def __init__(self, path: str, words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        self.words = words
        self._forget()

    def _forget(self) -> None:
        self._empty(LEAST_SLOTS)
        self.ids, self.used, self.known = np.zeros(1 << 16, "<u4"), 0, 0

    def _empty(self, slots: int) -> None:
        self.slots, self.keys = slots, np.zeros(slots, np.uint64)
        self.at, self.size = np.zeros(slots, np.uint32), np.zeros(slots, np.uint32)

    def rest(self) -> None:
        """A task is over: the words learnt first stay for the next one, and all others go."""
        if self.known > REST_WORDS or self.used > REST_IDS:
            old = np.flatnonzero(self.keys)
            old = old[np.argsort(self.at[old], kind="stable")][:REST_WORDS]
            old = old[np.cumsum(self.size[old], dtype=np.int64) <= REST_IDS]
            keys, offsets, sizes, ids = self.keys[old], self.at[old], self.size[old], self.ids
            self._forget()
            if len(old):  # ids lie in the order of learning, without gaps
                self.known, self.used = len(old), int(offsets[-1]) + int(sizes[-1])
                self.ids = ids[: max(self.used, 1)].copy()
                self._empty(power_of_two(max(2 * len(old), LEAST_SLOTS)))
                self._put(keys, offsets, sizes)
        give_back()

    def _slots_of(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or the free slot where its search ends."""
        slot = (keys & np.uint64(self.slots - 1)).astype(np.int64)
        open_ = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (self.slots - 1)
            there = self.keys[slot[open_]]
            open_ = open_[(there != keys[open_]) & (there != 0)]
        return slot

    def _put(self, keys: np.ndarray, offsets: np.ndarray, sizes: np.ndarray) -> None:
        """Distinct keys that the table doesn't have into free slots."""
        while len(keys):  # keys that meet in a free slot: one gets it, the others search on
            slot = self._slots_of(keys)
            self.keys[slot] = keys
            won = self.keys[slot] == keys
            self.at[slot[won]], self.size[slot[won]] = offsets[won], sizes[won]
            keys, offsets, sizes = keys[~won], offsets[~won], sizes[~won]

    def _make_room(self, more: int) -> None:
        """Two slots at least for each word, with so many more."""
        slots = power_of_two(2 * (self.known + more))
        if slots > self.slots:
            old = np.flatnonzero(self.keys)
            keys, offsets, sizes = self.keys[old], self.at[old], self.size[old]
            self._empty(slots)
            self._put(keys, offsets, sizes)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Distinct new keys and their words into the table."""
        self._make_room(len(words))
        for low in range(0, len(words), 4096):
            found = [e.ids for e in self.encode(words[low : low + 4096], add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.uint32, len(found))
            flat = np.fromiter((i for own in found for i in own), "<u4", int(sizes.sum()))
            while self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
            self.ids[self.used : self.used + len(flat)] = flat
            self._put(keys[low : low + 4096], (self.used + np.cumsum(sizes) - sizes).astype(np.uint32), sizes)
            self.used += len(flat)
        self.known += len(words)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column side by side, and where each text's begin (n + 1 places)."""
        keys, first, starts, ends, data = words(column, lower=False)
        keys[keys == 0] = 1
        slot = self._slots_of(keys)
        new = np.flatnonzero(self.keys[slot] == 0)
        if len(new):
            fresh, where = np.unique(keys[new], return_index=True)
            where = new[where]
            if self.known + len(fresh) > self.words or self.used > CACHE_IDS:
                fresh, where = np.unique(keys, return_index=True)
                self.words = max(self.words, len(fresh))  # one text of very many words makes room for itself
                self._forget()
            self._learn(fresh, [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(starts[where], ends[where], strict=True)])
            slot = self._slots_of(keys)
        sizes = self.size[slot].astype(np.int64)
        total = np.concatenate(([0], np.cumsum(sizes)))
        places = np.arange(total[-1]) + np.repeat(self.at[slot].astype(np.int64) - total[:-1], sizes)
        return self.ids[places], total[first]


@lru_cache(maxsize=2)
def _word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


def _pieces(path: str, capacity: int, with_ids: bool):
    """(id, text) -> one row per piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _word_tokens(path)
        end = np.array([END_ID], "<u4")
        for batch in batches:
            owner, piece, start, length, crc, ids = [], [], [], [], [], []
            for low, high in slices(batch.column("text")):
                flat, first = tokens(batch.column("text").slice(low, high - low))
                for row, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True), low):
                    whole = np.concatenate((flat[a:b], end))
                    for k, at in enumerate(range(0, len(whole), capacity)):
                        part = whole[at : at + capacity]
                        owner.append(row)
                        piece.append(k)
                        start.append(at)
                        length.append(len(part))
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(part.astype("<i4"))
            columns = [batch.column("id").take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["id", "piece", "start", "length", "crc"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
        tokens.rest()

    return run


def tokenized_pieces(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece of at most `capacity` tokens: id, piece, start, length, crc and, if asked, ids."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(_pieces(tokenizer_path, capacity, with_ids), f"id {kind}, piece int, start long, length long, crc long" + ", ids array<int>" * with_ids)


Pattern = tuple[tuple[tuple[int, int], ...], int]  # ((length, how many), ...), sequences


def reduce_dominated(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Fix dominating sets, longest documents first, and take them out of counts. counts[L]: documents of length L."""
    fixed: list[Pattern] = []
    for length in range(capacity, 0, -1):
        while counts[length] > 0:
            room = capacity - length
            counts[length] -= 1  # the partner may be of the same length
            there = np.flatnonzero(counts[: room + 1])
            counts[length] += 1
            if not len(there):
                fixed.append((((length, 1),), int(counts[length])))
                counts[length] = 0
                break
            partner, least = int(there[-1]), int(there[0])
            second = least if counts[least] - (least == length) > 1 else int(there[1]) if len(there) > 1 else capacity + 1
            if partner != room and least + second <= room:
                break  # two documents may fit beside this one: nothing is proved
            if partner == length:
                n = int(counts[length]) // 2
                fixed.append((((length, 2),), n))
                counts[length] -= 2 * n
            else:
                n = int(min(counts[length], counts[partner]))
                fixed.append((((length, 1), (partner, 1)), n))
                counts[length] -= n
                counts[partner] -= n
    return fixed


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best-fit decreasing over a histogram, equal sequences in groups."""
    open_: list[list[Pattern]] = [[] for _ in range(capacity + 1)]  # by room left
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        for room in range(length, capacity + 1):
            groups, open_[room] = open_[room], []
            fit = room // length
            while groups and left:
                items, many = groups.pop()
                full = min(many, left // fit)
                if full:
                    open_[room - fit * length].append((items + ((length, fit),), full))
                    left -= full * fit
                    many -= full
                if many and 0 < left < fit:
                    open_[room - left * length].append((items + ((length, left),), 1))
                    many, left = many - 1, 0
                if many:
                    groups.append((items, many))
            open_[room] += groups
            if not left:
                break
        fit = capacity // length
        if left >= fit:
            open_[capacity - fit * length].append((((length, fit),), left // fit))
        if left % fit:
            open_[capacity - (left % fit) * length].append((((length, left % fit),), 1))
        counts[length] = 0
    return [group for groups in open_ for group in groups]


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Where the k-th document of each length goes: runs (length, from, sequence, offset, width), sorted by (length, from).

    A run starts at number `from` of its length. Number k lies in sequence + (k - from) // width at offset
    offset + length * ((k - from) % width).
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    patterns = reduce_dominated(counts, capacity)
    patterns += best_fit(counts, capacity)
    used = np.zeros(capacity + 1, np.int64)
    runs, sequence = [], 0
    for items, many in patterns:
        offset = 0
        for length, width in items:
            runs.append((length, int(used[length]), sequence, offset, width))
            used[length] += many * width
            offset += length * width
        sequence += many
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    return {"length": table[:, 0], "from": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3], "width": table[:, 4], "sequences": np.array([sequence])}


def _places(plan):
    """Adds sequence_id and offset to numbered pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        first = np.searchsorted(p["length"], np.arange(p["length"].max(initial=0) + 2))
        for batch in batches:
            length, number = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "number"))
            at = np.empty(len(length), np.int64)
            for value in np.unique(length):
                own = length == value
                a, b = first[value], first[value + 1]
                at[own] = a + np.searchsorted(p["from"][a:b], number[own], "right") - 1
            step = number - p["from"][at]
            sequence, offset = p["sequence"][at] + step // p["width"][at], p["offset"][at] + length * (step % p["width"][at])
            keep = batch.drop_columns(["number"])
            yield keep.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    return run


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to (id, piece, start, length, crc); pieces must be a stored table."""
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    plan = pieces.sparkSession.sparkContext.broadcast(plan_sequences(histogram, capacity))
    # A frequent length gets more buckets; the table of lengths has at most `capacity` rows.
    frequent = [(length, -(-n // BUCKET_ROWS)) for length, n in histogram.items()]
    buckets = F.broadcast(pieces.sparkSession.createDataFrame(frequent, "length long, buckets long"))
    rows = pieces.join(buckets, "length").withColumn("bucket", F.pmod(F.xxhash64("id", "piece", "crc"), F.col("buckets")).cast("int")).drop("buckets")
    each = rows.groupBy("length", "bucket").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    each = each.select("length", "bucket", F.coalesce(F.sum("rows").over(earlier), F.lit(0).cast("long")).alias("before"))
    own = Window.partitionBy("length", "bucket").orderBy("id", "piece", "crc")
    numbered = rows.withColumn("row", F.row_number().over(own)).join(each, ["length", "bucket"]).withColumn("number", F.col("before") + F.col("row") - 1)
    kind = pieces.schema["id"].dataType.simpleString()
    return numbered.select("id", "piece", "start", "length", "crc", "number").mapInArrow(_places(plan), f"id {kind}, piece int, start long, length long, crc long, sequence_id long, offset long")


def pack_documents(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Tokenize, cut and pack: one row per piece, with id_col, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and the end id 0; only documents longer than `capacity` are cut, into pieces of `capacity`
    tokens and a last one that may be shorter. Every sequence is filled from offset 0 without gaps.

    Null and empty texts are one piece of one token. Null ids are kept. Repeated rows are packed as often as they occur.
    An empty table gives no rows. Other columns play no part.
    """
    scratch = Scratch(df.sparkSession, "packing")
    pieces = scratch.save(tokenized_pieces(df, tokenizer_path, id_col, text_col, capacity), "pieces")
    out = pack_pieces(pieces, capacity)
    return out.select(F.col("id").alias(id_col), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset")


def default_tokenizer() -> str:
    """The vocabulary file of the contract; its place is a parameter of the operator."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pack_documents over all rows and whole texts of documents."""
    return pack_documents(read_table(spark, sf_dir, "documents"), default_tokenizer())
