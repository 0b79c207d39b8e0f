"""Quality classifier: hashed word n-gram logistic regression, trained by follow-the-regularised-leader updates.

A text is a stream of word pieces (runs of word characters, runs of other characters). Three kinds of hashed n-grams
are drawn from it: single pieces, pairs of pieces, and pairs and triples of piece shapes (letter case, digits, the
punctuation run itself, "same as the piece before"). The score of a text is the logistic function of a sparse dot
product: the weights of its n-grams, averaged over each kind, so that long and short texts compare.

The model is fitted on a bounded sample of labelled rows, MAX_TRAIN of them in the order of a seeded hash of the id,
by FTRL-Proximal, one pass at a time over rows in that order. A pass is one task that streams the sample's features from a
sort (which spills) and holds no more than a batch of them; the state between passes (2 ** BITS pairs of numbers, 4 MB)
and the weights (1 MB) are all that is ever broadcast. Scoring reads every whole text once and
shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import Scratch, bound_batches, read_table
from corpusmill.llm.kernels import IS_SPACE, LOWER, hash_spans, mix64, runs_of, slices, text_buffer

BITS = 18
#: Labelled rows that the model is fitted on, at most (a documented bound; rows are taken in seeded hash order).
MAX_TRAIN = 8_000
THRESHOLD = 0.7
PASSES = 3
SEED = 29
#: FTRL-Proximal: step size, smoothing, L1 and L2 penalties. SCALE weighs the averaged n-grams.
ALPHA, BETA, L1, L2, SCALE = 0.3, 1.0, 0.002, 0.02, 12.0
#: Added to the token count that n-grams are averaged over: a text of a few words stays near the bias.
PRIOR = 8

_KIND = np.full(256, 1, np.uint8)  # 0 space, 1 other, 2 lower-case or beyond ASCII, 3 upper-case, 4 digit
_KIND[IS_SPACE] = 0
_KIND[97:123] = 2
_KIND[128:] = 2
_KIND[65:91] = 3
_KIND[48:58] = 4
_SHAPES = np.array([0x51ED, 0xA7C3, 0x1F35, 0x77B1, 0x2C9F], np.uint64)


def ngrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of each text: (4, tokens) feature indices, and the first token of each text (n + 1 indices)."""
    data, offsets = text_buffer(column)
    kind = _KIND[data]
    word = kind >= 2
    ws, we = runs_of(word, offsets)
    ps, pe = runs_of(kind == 1, offsets)
    starts, ends = np.concatenate((ws, ps)), np.concatenate((we, pe))
    order = np.argsort(starts, kind="stable")
    starts, ends, is_word = starts[order], ends[order], order < len(ws)
    low = LOWER[data]
    piece = hash_spans(low, starts, ends)
    count = np.zeros((2, len(data) + 1), np.int32)
    np.cumsum(kind == 3, out=count[0, 1:])
    np.cumsum(kind == 4, out=count[1, 1:])
    upper = count[0, ends] - count[0, starts]
    digits = count[1, ends] - count[1, starts]
    length = ends - starts
    plain = np.where(upper == 0, 0, np.where((upper > 1) & (upper * 2 >= length), 2, 1))
    shape = _SHAPES[np.where(digits > 0, 3, plain)]
    shape = np.where(is_word, shape, piece)
    first = np.searchsorted(starts, offsets)
    same = np.zeros(len(piece), bool)
    same[1:] = piece[1:] == piece[:-1]
    same[first[:-1][first[:-1] < len(piece)]] = False
    shape = np.where(same & is_word, _SHAPES[4], shape)

    def after(x: np.ndarray, k: int) -> np.ndarray:
        """x moved k tokens on; the first k tokens of a text get 0."""
        out = np.zeros(len(x), np.uint64)
        out[k:] = x[:-k] if len(x) > k else x[:0]
        for j in range(k):
            out[np.minimum(first[:-1] + j, max(len(x) - 1, 0))[first[:-1] + j < first[1:]]] = 0
        return out

    two = np.uint64(0x9E3779B97F4A7C15)
    grams = [piece, mix64(after(piece, 1) * two + piece), mix64(after(shape, 1) * two + shape + np.uint64(11))]
    grams.append(mix64((after(shape, 2) * two + after(shape, 1)) * two + shape + np.uint64(23)))
    return np.stack([(g >> np.uint64(64 - BITS)).astype(np.int32) for g in grams]), first


def example(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One text's sparse vector: distinct indices and averaged counts; index 0 is the bias."""
    index, count = np.unique(grams, return_counts=True)
    value = count * (SCALE / (grams.shape[1] + PRIOR) / len(grams))
    return np.concatenate(([0], index)), np.concatenate(([1.0], value))


class Ftrl:
    """FTRL-Proximal: z and n of every feature, updated by one row at a time."""

    def __init__(self, z: np.ndarray | None = None, n: np.ndarray | None = None):
        self.z = np.zeros(1 << BITS) if z is None else z.copy()
        self.n = np.zeros(1 << BITS) if n is None else n.copy()

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def update(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
        g = (p - label) * value
        n0 = self.n[at]
        self.z[at] += g - (np.sqrt(n0 + g * g) - np.sqrt(n0)) / ALPHA * w
        self.n[at] = n0 + g * g


def score(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Scores of whole texts: a sparse dot product each. Without any n-gram the bias decides."""
    parts = [_score(column.slice(a, b - a), weights) for a, b in slices(column)]
    return np.concatenate(parts) if parts else np.zeros(0)


def _score(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    grams, first = ngrams(column)
    total = np.zeros(grams.shape[1] + 1)
    np.cumsum(weights[grams].sum(axis=0, dtype=np.float64), out=total[1:])
    tokens = first[1:] - first[:-1] + PRIOR
    raw = float(weights[0]) + (total[first[1:]] - total[first[:-1]]) * (SCALE / len(grams)) / tokens
    return 1 / (1 + np.exp(-np.clip(raw, -35, 35)))


def held_out(id_: Column) -> Column:
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for low, high in slices(batch.column("text")):
            grams, first = ngrams(batch.column("text").slice(low, high - low))
            rows += [example(grams[:, a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("place"), batch.column("label"), pa.array([r[0].astype("<i4").tobytes() for r in rows], pa.binary()), pa.array([r[1].astype("<f4").tobytes() for r in rows], pa.binary())],
            ["place", "label", "at", "value"],
        )


def _one_pass(state):
    """One pass over the ordered rows of one task: state in, state out; no more than a batch of rows is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, rows = Ftrl(*(np.frombuffer(x) for x in state.value)) if state else Ftrl(), 0
        for batch in batches:
            for label, at, value in zip(*(batch.column(c) for c in ("label", "at", "value")), strict=True):
                model.update(np.frombuffer(at.as_py(), "<i4"), np.frombuffer(value.as_py(), "<f4").astype(float), label.as_py())
                rows += 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([model.z.tobytes()], pa.binary()), pa.array([model.n.tobytes()], pa.binary())], ["z", "n"])

    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_TRAIN) -> np.ndarray:
    """Weights fitted on labelled rows that are not held out. labels: (id_col, label_col); nulls in either are left out.

    Ids with several labels count as what the most of them say, 0 if as many. Without labelled rows all weights are 0
    (score 0.5).
    """
    votes = labels.select(F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("label")).where("id IS NOT NULL AND label IS NOT NULL").where(~held_out(F.col("id")))
    place = F.xxhash64(F.lit(SEED), "id")
    chosen = votes.groupBy("id").agg((F.avg("label") > 0.5).cast("int").alias("label")).withColumn("place", place).orderBy("place", "id").limit(max_rows)
    # Bounded by max_rows, so broadcasting the chosen ids is safe at any input size.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select("place", "label", "text")
    scratch = Scratch(docs.sparkSession, "quality")
    features = scratch.save(rows.mapInArrow(_features, "place long, label int, at binary, value binary"), "features")
    ordered = features.repartition(1).sortWithinPartitions("place", "at", "value").select("label", "at", "value")
    state = None
    for _ in range(PASSES):
        done = ordered.mapInArrow(_one_pass(state), "z binary, n binary").collect()  # one row of 4 MB
        if not done:
            break
        state = docs.sparkSession.sparkContext.broadcast((bytes(done[0]["z"]), bytes(done[0]["n"])))
    scratch.drop(features)
    return Ftrl(*(np.frombuffer(x) for x in state.value)).weights().astype(np.float32) if state else np.zeros(1 << BITS, np.float32)


def score_quality(df: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Adds score (double, 0 to 1, higher: better) and predicted (1 if score >= threshold, else 0) to the columns of df.

    Null and empty texts get the score of the bias alone. Columns of df called score or predicted are replaced. Repeated
    rows get equal scores; an empty table stays empty. id, source and language are never read for a score.
    """
    keep = [c for c in df.columns if c not in ("score", "predicted")]
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def score_of(texts: pa.Array) -> pa.Array:
        return pa.array(score(texts, shared.value))

    out = df.select(*[F.col(f"`{c}`") for c in keep], score_of(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores every whole text of documents, with a model fitted on labels.quality of rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    weights = train(docs, read_table(spark, sf_dir, "labels"))
    scored = score_quality(docs.select("doc_id", "text"), weights)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
