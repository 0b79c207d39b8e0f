"""Training-data operators against brute force, exact round trips and held-out accuracy, with the awkward inputs that their
docstrings define: nulls, empty and very long texts, ties, repeated rows, empty tables, clashing column names."""

import hashlib
import os
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from math import sqrt

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF, same_rows
from pyspark.sql import functions as F

from corpusmill.llm import ann, exact_dedup, kernels, licenses, line_dedup, mixing, near_dedup, packing, pii, quality, registry, secrets

RNG = random.Random(11)
WORDS = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(RNG.randint(2, 9))) for _ in range(300)]
SPACE = " \t\n\x0b\x0c\r"


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def docs(spark, rows, extra=""):
    """(doc_id, text, source) rows with further columns whose names clash with inner ones."""
    clash = [(*r, "x", 1, "y", 2.0, "z") for r in rows]
    return spark.createDataFrame(clash, "doc_id long, text string, source string, id string, n int, row_key string, score double, bucket string")


AWKWARD = [(1, None, "a"), (2, "", "a"), (3, " \n ", None), (4, "x" * 50_000, "a"), (5, "same text here", "b"), (5, "same text here", "b"), (None, "same text here", "b"), (7, "ünï cödé 東京 text", "c"), (8, ("word " * 20_000), "c")]


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert same_rows(duck, registry.queries()[name](spark, SF), registry.oracle_sql()[name]) == (0, 0)


# ------------------------------------------------------------------ kernels


def test_word_hashes_follow_words():
    texts = ["Ab  c\tAB c", "", None, "é É ab", "x" * 3_000_000 + " ab", "a", "b"]
    hashes, first, *_ = kernels.words(pa.array(texts))
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    plain = [re.findall(r"[^\x20\x09-\x0D]+", low(t)) for t in texts]
    assert [int(b - a) for a, b in zip(first[:-1], first[1:])] == [len(p) for p in plain]
    seen = {}
    for word, h in zip([w for p in plain for w in p], hashes.tolist(), strict=True):
        assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)
    sliced = pa.array(["zz zz", *texts]).slice(1)
    assert (kernels.words(sliced)[0] == hashes).all()
    assert [b - a for a, b in kernels.slices(pa.array(texts), 1000)] == [4, 1, 2]


# ------------------------------------------------------------------ 1 quality


def test_quality_is_learnt(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(600):
        good = k % 3 != 0
        text = prose(60, rng) if good else (prose(60, rng).upper().replace(" ", "!! ") if k % 2 else " ".join(w for w in prose(6, rng).split() for _ in range(10)))
        rows.append((k, text, "s"))
        labels.append((k, int(good)))
    frame = docs(spark, rows)
    weights = quality.train(frame, spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, quality int"))
    scored = quality.score_quality(frame, weights).select("doc_id", quality.held_out(F.col("doc_id")).alias("held"), "score", "predicted").collect()
    for r in scored:
        assert r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [r for r in scored if r.held]
    assert len(held) > 80 and sum(r.predicted == (r.doc_id % 3 != 0) for r in held) >= 0.97 * len(held)
    shuffled = quality.train(frame.repartition(7), spark.createDataFrame(labels, "doc_id long, quality int").repartition(3))
    assert np.allclose(shuffled, weights)


def test_ftrl_and_scores_against_plain_python(spark):
    """Training by dictionaries, one feature at a time, and scores summed one n-gram at a time."""
    rng = random.Random(15)
    rows = [(k, prose(rng.choice([0, 1, 5, 30]), rng).title() if k % 3 else prose(8, rng) + " 12, A!! a a", "s") for k in range(60)] + [(90, None, "s"), (91, "", "s")]
    labels = [(k, int(k % 3 > 0)) for k in range(60)] + [(3, 1), (3, 1), (4, 0)]
    frame = docs(spark, rows)
    got = quality.train(frame, spark.createDataFrame(labels, "doc_id long, quality int"))

    def features(text):
        grams, _ = quality.ngrams(pa.array([text or ""]))
        counts = Counter(grams.reshape(-1).tolist())
        return {0: 1.0} | {k: float(np.float32(c * (quality.SCALE / (grams.shape[1] + quality.PRIOR) / len(grams)))) for k, c in counts.items()}, grams.shape[1]

    votes, text_of = defaultdict(list), {r[0]: r[1] for r in rows}
    for k, q in labels:
        if zlib.crc32(str(k).encode()) % 4 != 2:
            votes[k].append(q)
    order = [r.id for r in spark.createDataFrame([(k,) for k in votes], "id long").orderBy(F.xxhash64(F.lit(quality.SEED), "id")).collect()]
    z, n = defaultdict(float), defaultdict(float)
    weight = lambda k: 0.0 if abs(z[k]) <= quality.L1 else -(z[k] - np.sign(z[k]) * quality.L1) / ((quality.BETA + sqrt(n[k])) / quality.ALPHA + quality.L2)
    for _ in range(quality.PASSES):
        for k in order:
            own, _ = features(text_of[k])
            p = 1 / (1 + np.exp(-sum(weight(f) * v for f, v in own.items())))
            label = int(sum(votes[k]) / len(votes[k]) > 0.5)
            for f, v in own.items():
                w, g = weight(f), (p - label) * v
                z[f] += g - (sqrt(n[f] + g * g) - sqrt(n[f])) / quality.ALPHA * w
                n[f] += g * g
    plain = np.zeros(1 << quality.BITS)
    for f in list(z):
        plain[f] = weight(f)
    assert np.count_nonzero(plain) > 100 and np.allclose(got, plain, atol=1e-5)
    for r in quality.score_quality(frame, got).collect():
        own, _ = features(r.text)
        assert r.score == pytest.approx(1 / (1 + np.exp(-sum(float(got[f]) * v for f, v in own.items()))), abs=1e-5) and r.predicted == (r.score >= quality.THRESHOLD)


def test_op1_on_held_out_labels(spark):
    """The query on supplied tables: every document once, and held-out documents as they are labelled."""
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in quality.op1_quality(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in got.items())
    held = [k for k in labels if k in got and got[k].held_out]
    assert len(held) >= 80 and sum(got[k].predicted == labels[k] for k in held) >= 0.97 * len(held)


def test_quality_awkward(spark):
    weights = np.zeros(1 << quality.BITS, np.float32)
    weights[0] = 1.0
    got = quality.score_quality(docs(spark, AWKWARD), weights)
    assert got.count() == len(AWKWARD) and got.where("score BETWEEN 0 AND 1").count() == len(AWKWARD)
    assert got.where("doc_id = 1").first().score == pytest.approx(1 / (1 + np.exp(-1)))
    assert quality.score_quality(docs(spark, AWKWARD).limit(0), weights).count() == 0
    assert not quality.train(docs(spark, AWKWARD), spark.createDataFrame([], "doc_id long, quality int")).any()


# ------------------------------------------------------------------ 2 nearest neighbours


def brute_nearest(rows, k):
    fine = [(i, np.array(x, float)) for i, x in rows if x is not None and None not in x and np.isfinite(np.array(x, float)).all() and any(x)]
    out = {}
    for i, x in fine:
        if i % 20 == 0:
            found = sorted(((-float((y * x).sum()), j) for j, y in fine if j != i))[:k]
            out[i] = [j for _, j in found]
    return out


def test_ann_recall_and_ties(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 16)) * 2
    rows = [(i, (centres[i % 6] + rng.normal(size=16)).round(3).tolist()) for i in range(3000)]
    rows += [(3000 + i, rows[20][1]) for i in range(60)]
    rows += [(4000, None), (4020, [0.0] * 16), (4040, [float("nan")] * 16), (4060, [None] + [1.0] * 15), (4080, [float("inf")] + [1.0] * 15)]
    frame = spark.createDataFrame([(i, x, 1) for i, x in rows], "vec_id long, embedding array<double>, rank int")
    got = defaultdict(list)
    for r in ann.nearest(frame, frame.where("vec_id % 20 = 0"), k=20).orderBy("query_id", "rank").collect():
        assert r.rank == len(got[r.query_id]) + 1
        got[r.query_id].append(r.vec_id)
    want = brute_nearest(rows, 20)
    assert set(got) == set(want)
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 20 * len(want)
    copies = [v for v in got[3020] if v == 20 or v >= 3000]
    assert copies == sorted(copies)


def test_ann_small_and_empty(spark):
    frame = spark.createDataFrame([(20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [2.0, 0.0])], "vec_id long, embedding array<float>")
    got = ann.nearest(frame, frame.where("vec_id = 20")).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(2, 2.0), (1, 0.5)]
    assert ann.nearest(frame.limit(0), frame).count() == 0


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01", "sf0.1", "check_s", "check_l"])
def test_ann_query_recall(spark, name):
    """op2 on whole supplied tables against brute force, on a hundred of its queries."""
    import pyarrow.parquet as pq

    if not os.path.exists(f"/root/testdata/{name}/embeddings.parquet"):
        pytest.skip("no such table here")
    table = pq.read_table(f"/root/testdata/{name}/embeddings.parquet")
    rows = [(i, x) for i, x in zip(table.column("vec_id").to_pylist(), table.column("embedding").to_pylist(), strict=True) if x is not None and None not in x and np.isfinite(np.array(x, float)).all() and any(x)]
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    got = defaultdict(list)
    for r in ann.op2_ann(spark, f"/root/testdata/{name}").orderBy("query_id", "rank").collect():
        assert r.rank == len(got[r.query_id]) + 1
        got[r.query_id].append((r.vec_id, r.score))
    asked = [i for i in ids.tolist() if i % 20 == 0]
    assert set(got) == set(asked) and all(len(x) == 20 for x in got.values())
    hits, some = 0, asked[:: max(1, len(asked) // 100)]
    for q in some:
        score = (vectors * vectors[ids == q][0]).sum(axis=1)
        score[ids == q] = -np.inf
        best = np.lexsort((ids, -score))[:20]
        hits += len({v for v, _ in got[q]} & set(ids[best].tolist()))
        assert all(x == pytest.approx(score[ids == v][0], abs=1e-12) for v, x in got[q])
    assert hits >= 0.95 * 20 * len(some)


def test_ann_takes_components_of_any_size(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (x * 1e200).tolist()) for i, x in enumerate(rng.normal(size=(60, 4)))] + [(100 + i, x.tolist()) for i, x in enumerate(rng.normal(size=(60, 4)))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert ann.nearest(frame, frame.where("vec_id % 20 = 0"), k=5).count() == 5 * 6


# ------------------------------------------------------------------ 3 packing


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    rows = AWKWARD + [(100 + k, prose(RNG.choice([5, 60, 300, 900])), "s") for k in range(60)] + [(300, "a <|endoftext|> b\x1cc  d's I'LL Σας. É, ", "s")]
    tokens = Tokenizer.from_file(path)
    want = Counter()
    for doc_id, text, _ in rows:
        ids = tokens.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            want[doc_id, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(np.array(ids[k : k + 2048], "<u4").tobytes())] += 1
    got = packing.pack_documents(docs(spark, rows), path).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= sum(r.length for r in got) / 2048 * 1.1 + 1
    assert packing.pack_documents(docs(spark, rows).limit(0), path).count() == 0


def test_word_table_forgets_and_grows():
    rng = random.Random(12)
    texts = [prose(rng.choice([1, 40, 200]), rng).title() for _ in range(60)] + ["x" * 5000, "Ünï. cödé, 東京 \x1c a\x1db", "", None, "a <|endoftext|>b"]
    table = packing.WordTokens(packing.default_tokenizer(), 100)
    column = pa.array(texts)
    for a, b in kernels.slices(column, 2000):
        ids, first = table(column.slice(a, b - a))
        for k in range(a, b):
            assert ids[first[k - a] : first[k - a + 1]].tolist() == table.tokenizer.encode(texts[k] or "", add_special_tokens=False).ids
    assert table.words > 100


def test_a_worker_rests_with_a_small_word_table(monkeypatch):
    path, rng = packing.default_tokenizer(), random.Random(13)
    packing._word_tokens.cache_clear()
    table, run = packing._word_tokens(path), packing._pieces(path, 2048, True)
    first = [f"{rng.getrandbits(40):x}" for _ in range(50)]

    def task(words_):
        batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([" ".join(words_)])], ["id", "text"])
        got = [i for part in run(iter([batch])) for own in part.column("ids").to_pylist() for i in own]
        assert got == [*table.tokenizer.encode(" ".join(words_), add_special_tokens=False).ids, 0]
        return sum(x.nbytes for x in (table.keys, table.at, table.size, table.ids))

    assert task(first) <= 1 << 20 and table.known == 50
    monkeypatch.setattr(packing, "REST_WORDS", 1000)
    for _ in range(2):
        assert task(first + [f"{rng.getrandbits(40):x}" for _ in range(20_000)]) <= 1 << 20 and table.known == 1000
    monkeypatch.setattr(packing, "REST_IDS", 100)
    assert task(first) <= 1 << 20 and table.known < 50 and table.used <= 100
    monkeypatch.setattr(packing, "REST_IDS", 0)
    assert task(first) <= 1 << 20 and table.known == 0 and table.used == 0
    packing._word_tokens.cache_clear()


def best_fit_decreasing(lengths, capacity):
    room = []
    for x in sorted(lengths, reverse=True):
        fits = [k for k, r in enumerate(room) if r >= x]
        if fits:
            room[min(fits, key=lambda k: room[k])] -= x
        else:
            room.append(capacity - x)
    return len(room)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_no_worse_than_best_fit(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([rng.randint(1, 100), rng.randint(1, 30), 60, 40, 100]) for _ in range(400)]
    plan = packing.plan_sequences(Counter(lengths), 100)
    n = int(plan["sequences"][0])
    assert -(-sum(lengths) // 100) <= n <= best_fit_decreasing(lengths, 100)
    used, counts = defaultdict(list), Counter(lengths)
    for length, count in counts.items():
        own = plan["length"] == length
        for k in range(count):
            run = np.flatnonzero(own)[np.searchsorted(plan["from"][own], k, "right") - 1]
            step = k - plan["from"][run]
            used[int(plan["sequence"][run] + step // plan["width"][run])].append((int(plan["offset"][run] + length * (step % plan["width"][run])), length))
    assert set(used) == set(range(n))
    for own in used.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 100


def test_dominance_fixes_exact_partners():
    counts = np.zeros(11, np.int64)
    counts[[10, 7, 3, 6, 5]] = [2, 3, 2, 1, 4]
    fixed = packing.reduce_dominated(counts, 10)
    assert ((((10, 1),), 2)) in fixed and (((7, 1), (3, 1)), 2) in fixed and (((5, 2),), 2) in fixed
    assert counts.sum() == 0  # the rest has no partner left and is fixed alone


# ------------------------------------------------------------------ 4 lines


def test_lines_against_plain_python(spark):
    rng = random.Random(8)
    rows = []
    for k in range(80):
        lines = [prose(4, rng) for _ in range(3)] + ["  menu home  "] * (k % 2) * 2 + ["", "rare line"] * (k % 40 == 0)
        rows.append((k, "\n".join(lines), "a" if k < 60 else None))
    rows += AWKWARD
    gone = {}
    for host in {r[2] for r in rows}:
        own = [r for r in rows if r[2] == host]
        counts = Counter(x for r in own for x in {y.strip(" \t\r") for y in (r[1] or "").split("\n")} if x)
        gone[host] = {x for x, n in counts.items() if n >= 5 and n > 0.1 * len(own)}
    assert gone["a"] == {"menu home"}
    want = Counter()
    for i, t, h in rows:
        kept = [x for x in (t or "").split("\n") if x.strip(" \t\r") not in gone[h]]
        want[i, "\n".join(kept) if t is not None else None, len((t or "").split("\n")) - len(kept)] += 1
    got = line_dedup.dedup_lines(docs(spark, rows), "source")
    assert Counter((r.doc_id, r.text, r.lines_dropped) for r in got.collect()) == want
    assert got.columns[:8] == docs(spark, rows).columns
    assert line_dedup.dedup_lines(docs(spark, rows).limit(0)).count() == 0


def test_lines_of_very_many_hosts_are_joined_by_shuffles(spark, monkeypatch):
    rows = [(k, f"head {k % 3}\nown {k}\nfoot", f"h{k % 3}") for k in range(60)]
    want = sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(docs(spark, rows), "source").collect())
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 0)
    assert sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(docs(spark, rows), "source").collect()) == want and want[0][1] == "own 0"


# ------------------------------------------------------------------ 5 near duplicates


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set()


def plain_components(rows, width, percent=80):
    """All pairs: id -> (set size, smallest id reachable). Counts of common shingles come from one matrix product."""
    sets = [(i, shingles(t, width)) for i, t, _ in rows if i is not None]
    often = Counter(x for _, own in sets for x in own)
    place = {x: k for k, x in enumerate(x for x, n in often.items() if n > 1)}
    there = np.zeros((len(sets), len(place) + 1), np.float32)
    for k, (_, own) in enumerate(sets):
        there[k, [place[x] for x in own if x in place]] = 1
    common, size = there @ there.T, np.array([len(x) for _, x in sets])
    linked = (size[:, None] > 0) & (size[None, :] > 0) & (100 * common >= percent * (size[:, None] + size[None, :] - common))
    ids = [i for i, _ in sets]
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in zip(*(k.tolist() for k in np.nonzero(np.tril(linked, -1))), strict=True):
        i2, j2 = root(ids[a]), root(ids[b])
        parent[max(i2, j2)] = min(i2, j2)
    return {i: (len(x), root(i)) for i, x in sets}


@pytest.mark.parametrize("width", [4, 5])
def test_near_dedup_against_all_pairs(spark, width):
    rng = random.Random(width)
    base = [prose(rng.choice([3, 8, 40, 120]), rng).split() for _ in range(25)]
    rows = []
    for k in range(160):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        rows.append((k, ("  " if k % 3 else "\n").join(words).title() if k % 4 else " ".join(words), "s"))
    rows += [(500, None, "s"), (501, "", "s"), (502, " \n", "s"), (503, "one", "s"), (504, "ONE ", "s"), (505, "x" * 90_000, "s")]
    want = plain_components(rows, width)
    got = near_dedup.near_dedup(docs(spark, rows + [(None, "one", "s"), (503, "one", "s")]), width=width).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows) + Counter([None, 503])
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_near_dedup_finds_all_links_of_a_family_just_below_the_threshold(spark):
    """Texts of 100 out of 120 words (0.71 on average) fill the same buckets; some pairs reach 0.8."""
    rng = random.Random(21)
    rows = [(k, " ".join(rng.sample([f"t{i}" for i in range(120)], 100)), "s") for k in range(600)]
    want = plain_components(rows, 1)
    assert 20 <= sum(c != i for i, (_, c) in want.items()) <= 300
    got = {r.doc_id: r.component_id for r in near_dedup.near_dedup(docs(spark, rows), width=1).collect()}
    assert got == {i: c for i, (_, c) in want.items()}


def test_sketches_and_sizes_refuse_no_link():
    rng = np.random.default_rng(4)
    sets = [rng.integers(1, 1 << 63, n, dtype=np.uint64) for n in (300, 9, 20_000, 260) for _ in range(3)]
    sets += [np.r_[own[: int(0.9 * len(own))], rng.integers(1, 1 << 63, len(own) // 10, dtype=np.uint64)] for own in sets]
    n, component, count = np.array([len(x) for x in sets]), np.arange(len(sets)), len(sets)
    sketches = near_dedup.Sketches(n, [near_dedup.parity(x) for x in sets])
    assert len(sketches.tables) > 2 and (sketches.words * 64 >= 4 * n).all()
    links = {(i, j) for j in component for i in range(j) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    x, y = (k.reshape(-1) for k in np.meshgrid(component, component))
    good = sketches.close(x, y, 80)
    assert len(links) >= 8 and links <= set(zip(x[good].tolist(), y[good].tolist(), strict=True)) and good.sum() < len(x) // 3

    # Runs of blocks: left rows first. Pairs of a left and a right row, of two components; two rows outside of the major one once.
    def pairs(runs, major=None, alike=None):
        rows = [(g, left, k) for g, (lefts, rights) in enumerate(runs) for left, own in ((True, lefts), (False, rights)) for k in own]
        g, left, k = (np.array(c) for c in zip(*rows, strict=True))
        kinds = component if alike is None else alike
        some = near_dedup.Sketches(n[k], [near_dedup.parity(sets[q]) for q in k])
        a, b = near_dedup.open_pairs(g, left, np.isin(k, major or []), k, kinds[k], some, 80)
        return Counter((min(p), max(p)) for p in zip(k[a].tolist(), k[b].tolist(), strict=True))

    everyone, half = list(range(count)), count // 2
    assert set(pairs([(everyone, everyone)])) >= links and max(pairs([(everyone, everyone)]).values()) == 1
    cut = [(everyone[:half], everyone[:half]), (everyone[:half], everyone[half:]), (everyone[half:], everyone[:half]), (everyone[half:], everyone[half:])]
    assert pairs(cut) == pairs([(everyone, everyone)])
    assert not pairs([(everyone, everyone)], alike=component * 0) and not pairs([([], everyone), ([], [0])])
    assert set(pairs([(everyone[:half], everyone)], major=everyone[half:], alike=np.where(component >= half, 99, component))) >= links


def test_near_dedup_joins_late_members_of_a_large_group(spark):
    """A hub joins its near copies; the few members outside of that group meet all of it."""
    rng = random.Random(5)
    base = [f"t{i}" for i in range(200)]

    def changed(words, n):
        words = list(words)
        for at in rng.sample(range(len(words)), n):
            words[at] = f"new{rng.random()}"
        return words

    texts = [changed(base, rng.choice([1, 2, 3])) for _ in range(1500)]
    far = [changed(base, 30) for _ in range(8)]
    texts += far + [changed(w, 12) for w in far] + [changed(texts[k], 28) for k in range(40)]
    rows = [(k, " ".join(w), "s") for k, w in enumerate(texts)]
    want = plain_components(rows, 1)
    got = {r.doc_id: r.component_id for r in near_dedup.near_dedup(docs(spark, rows), width=1).collect()}
    assert got == {i: c for i, (_, c) in want.items()} and len(set(got.values())) > 1


@pytest.mark.parametrize("size,seed", [(500, 1), (500, 2), (500, 3), (1000, 1), (2000, 1)])
def test_near_dedup_loses_no_link_in_related_families(spark, size, seed):
    """Texts of one base with 2 to 8 of 200 words changed: links and near misses side by side."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(5000)]
    base, rows = [rng.choice(vocabulary) for _ in range(200)], []
    for k in range(size):
        words = list(base)
        for _ in range(rng.randint(2, 8)):
            words[rng.randrange(200)] = rng.choice(vocabulary)
        rows.append((k, " ".join(words), "s"))
    want = plain_components(rows, 5)
    got = {r.doc_id: r.component_id for r in near_dedup.near_dedup(docs(spark, rows)).collect()}
    assert got == {i: c for i, (_, c) in want.items()} and 1 < len(set(got.values())) < size


def test_near_dedup_without_the_filter(spark, monkeypatch):
    """Beyond the size of the Bloom filter a semi-join does the same."""
    rng = random.Random(31)
    base = [prose(50, rng).split() for _ in range(6)]
    rows = [(k, " ".join([*base[k % 6][: 50 - k % 4], *prose(k % 4, rng).split()]), "s") for k in range(60)]
    monkeypatch.setattr(near_dedup, "BLOOM_BITS", 1)
    got = {r.doc_id: r.component_id for r in near_dedup.near_dedup(docs(spark, rows)).collect()}
    assert got == {i: c for i, (_, c) in plain_components(rows, 5).items()}


def test_near_dedup_empty(spark):
    assert near_dedup.near_dedup(docs(spark, AWKWARD).limit(0)).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for n, same in ((400, 320), (60, 48), (9, 8)):
        agree = []
        for _ in range(60):
            pool = rng.integers(1, 1 << 63, 2 * n - same, dtype=np.uint64)
            x, y = np.sort(pool[:n]), np.sort(pool[n - same :])
            a, b = near_dedup.signatures([x, y])
            agree.append((a == b).mean())
        assert np.mean(agree) == pytest.approx(same / (2 * n - same), abs=0.06)


# ------------------------------------------------------------------ 6 personal data

TRICKY = [
    "a.b@c.d.e@f.g x@y _a@b.c_x@d.e", "1.2.3.4.5 256.1.1.1 001.02.3.255 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111" + "0" * 6, "+1 (947) 555-7668 +123 +1 234 567 890 123 456 7 ++49-30-1234567.",
    "é@x.y 東京a@b.co é1.2.3.4", "9" * 5000, "a" * 40_000 + "@b.c", "+1" + "(" * 3000, "%+-@-.-", "1 2 3 4 5 6 7 8 9 0 1 2 3", None, "",
]


def luhn(d):
    return sum(v if i % 2 == 0 else 2 * v - 9 * (v > 4) for i, v in enumerate(int(c) for c in reversed(d))) % 10 == 0


def plain_pii(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]


def test_pii_base_equals_plain_python(spark):
    rng = random.Random(6)
    rows = TRICKY[:6] + TRICKY[7:] + ["".join(rng.choice(["1", "23", ".", "@", "a", "+", "-", " ", "(", "4111111111111111", "9.9", "é"]) for _ in range(60)) for _ in range(150)]
    got = {r.doc_id: [tuple(x) for x in r.base] for r in pii.find_pii(docs(spark, [(i, t, "s") for i, t in enumerate(rows)])).collect()}
    assert got == {i: plain_pii(t or "") for i, t in enumerate(rows)}


def test_pii_long_run_is_linear(spark):
    row = pii.find_pii(docs(spark, [(1, TRICKY[6] * 5, "s")])).first()
    assert len(row.base) >= 1


def test_pii_bootstraps_contexts(spark):
    rng = random.Random(9)
    rows = []
    for k in range(40):
        card = next(c for c in (str(rng.randrange(10**15, 10**16)) for _ in iter(int, 1)) if luhn(c))
        rows.append((k, f"{prose(5, rng)} kontonummer {card} {prose(3, rng)} the 2024-{k:02d}-1{k} of {prose(3, rng)} mail: u{k}@ex.org {prose(2, rng)}", "s"))
    rows.append((100, "see kontonummer 1234-5678-99, or the 1999-12-31 of", "s"))
    got = {r.doc_id: r for r in pii.find_pii(docs(spark, rows)).collect()}
    found = got[100].found
    assert [(x.kind, rows[-1][1][x.s : x.e]) for x in found] == [("card", "1234-5678-99")]
    assert all(not got[k].found for k in range(40))
    masked = pii.mask_pii(spark.createDataFrame([r[:2] for r in rows[-1:]], "doc_id long, text string"), pii.find_pii(docs(spark, rows)))
    assert masked.first().text == "see kontonummer [card], or the 1999-12-31 of"


def test_pii_bootstraps_numbers_with_blanks(spark):
    rng = random.Random(10)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows = [(k, f"{prose(4, rng)} rufnummer +1 ({digits(3)}) {digits(3)}-{digits(4)} anrufen {prose(3, rng)}", "s") for k in range(30)]
    for k in range(30, 60):
        card = next(c for c in (digits(16) for _ in iter(int, 1)) if luhn(c))
        rows.append((k, f"{prose(4, rng)} kartennummer: {card[:4]} {card[4:8]} {card[8:12]} {card[12:]}, {prose(3, rng)}", "s"))
    rows += [(100, "rufnummer (017) 555-7713 und", "s"), (101, "see 017 555 7713 anrufen", "s"), (102, "kartennummer: 4111 1111 1111 1112.", "s"), (103, "+1  (017)   5 5 5  - 7713 anrufen 2024 99", "s"), (104, "1 2 3 4 " * 5000, "s")]
    got = {r.doc_id: r for r in pii.find_pii(docs(spark, rows)).collect()}
    found = {k: [(x.kind, dict((i, t) for i, t, _ in rows)[k][x.s : x.e]) for x in got[k].found] for k in got}
    assert {k: v for k, v in found.items() if v} == {100: [("phone", "(017) 555-7713")], 101: [("phone", "017 555 7713")], 102: [("card", "4111 1111 1111 1112")]}
    assert all([x.kind for x in got[k].base] == ["phone" if k < 30 else "card"] for k in range(60))


def test_pii_of_very_many_identifiers_is_close_to_linear(spark):
    rng, took = random.Random(13), {}
    parts = lambda n: [rng.choice(["10.0.{0}.7", "u{0}@ex.org", "n{0}x{0}", "wort {0}", "+49 (30) 55{0}"]).format(k % 250 + 1000 * (k % 3)) for k in range(n)]
    for n in (500, 8000, 16000):  # the first one compiles
        row = " ".join(parts(n))
        frame = docs(spark, [(1, row, "s")])
        began = time.perf_counter()
        found = pii.find_pii(frame).first()
        took[n] = time.perf_counter() - began
        assert [tuple(x) for x in found.base] == plain_pii(row)
    assert took[16000] <= 2.5 * took[8000] + 1


def test_pii_recall_and_precision_on_planted_formats(spark):
    """Identifiers in formats that no base pattern has, behind words that base identifiers taught, and decoys elsewhere."""
    rng = random.Random(16)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    card = lambda: next(c for c in (digits(16) for _ in iter(int, 1)) if luhn(c))
    seeds = {"phone": lambda: f"rufnummer +49 {digits(3)} {digits(7)}", "card": lambda: f"kartennummer {card()}", "email": lambda: f"postfach: u{digits(4)}@firma.de", "ip": lambda: f"rechner 10.{rng.randrange(256)}.{rng.randrange(256)}.7"}
    unseen = {"phone": lambda: digits(3) + "/" + digits(7), "card": lambda: digits(4) + "x" + digits(8), "email": lambda: f"u{digits(4)}@firma", "ip": lambda: f"300.{digits(3)}.9.1"}
    rows, want = [], {}
    for k in range(320):
        kind = list(seeds)[k % 4]
        rows.append((k, f"{prose(5, rng)} {seeds[kind]()} {prose(6, rng)}", "s"))
    for k in range(320, 400):
        kind = list(seeds)[k % 4]
        own, word = unseen[kind](), seeds[kind]().split()[0]
        head = f"{prose(4, rng)} {word} "
        rows.append((k, f"{head}{own} {prose(4, rng)} seite {digits(6)} am 2024-{digits(2)}-{digits(2)} {prose(3, rng)}", "s"))
        want[k] = (kind, len(head), len(head) + len(own))
    found = {r.doc_id: [(x.kind, x.s, x.e) for x in r.found] for r in pii.find_pii(docs(spark, rows)).collect()}
    hits = sum(want[k] in found[k] for k in want)
    reported = sum(len(x) for x in found.values())
    assert hits >= 0.9 * len(want) and hits >= 0.95 * reported


def test_op6_digests_follow_the_spans(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(TRICKY[:6] + TRICKY[7:])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for r in pii.op6_pii(spark, str(tmp_path)).collect():
        base = plain_pii(dict(rows)[r.doc_id] or "")
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x[0] == k for x in base) for k in pii.KINDS) and r.base_sha256 == hashlib.sha256(line.encode()).hexdigest() and r.spans == line and r.n_found == 0


def test_pii_awkward(spark):
    assert pii.find_pii(docs(spark, AWKWARD)).count() == len(AWKWARD)
    assert pii.find_pii(docs(spark, AWKWARD).limit(0)).count() == 0


# ------------------------------------------------------------------ 7 secrets


def plain_secrets(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18] + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return [(s, e, secrets.KINDS[k]) for s, k, e in sorted(out)]


def test_secret_base_equals_plain_python():
    rng = random.Random(7)
    parts = ["password", "Token", "api_KEY", "apikey", "ſecret", " ", "=", ":", '"', "'", "abc123", "deadbeefdeadbeef", "AKIA", "ABCDEFGH12345678", "é", "\n", "X" * 12]
    for t in ["", *("".join(rng.choice(parts) for _ in range(40)) for _ in range(400))]:
        assert secrets.base_spans(t) == plain_secrets(t), t


def test_secret_novelty():
    secret = "k9Qw3xLm7RtZ2vYb8NcD5sFh"
    text = f'client_secret_value: "{secret}"\nconnection_string = "your_password_here"\npassphrase("changeme_changeme_changeme1")'
    base = secrets.base_spans(text)
    assert [text[s:e] for s, e, _ in secrets.novel_spans(text, base)] == [secret]
    assert secrets.novelty(secret, "", "") > 0.8 > secrets.novelty("your_password_here", "", "")
    assert secrets.novelty(secret, f"x {secret} y", "") < 0.5
    assert secrets.novel_spans(f"the {secret} alone", []) == []


def test_repeated_secrets_are_found_everywhere():
    secret = "k9Qw3xLm7RtZ2vYb8NcD5sFhJ4gPq6Wn1XyT0aZe"
    for text in (f"private_key = {secret}\nprivate_key = {secret}\n", f"private_key={secret}\necho {secret}\n# private_key={secret}", f"private_key = {secret}\n{'x ' * 140}private_key = {secret}"):
        spans = secrets.novel_spans(text, [])
        assert [(s, e) for s, e, _ in spans] == [m.span() for m in re.finditer(secret, text)] and len(spans) >= 2
    assert secrets.novel_spans("private_key = your_password_here\n" * 2, []) == []


def test_secrets_of_aligned_assignments():
    secret = "k9Qw3xLm7RtZ2vYb8NcD5sFhJ4gPq6Wn1XyT0aZe"
    names = ["aws_secret_access_key      = ", 'private_key          = "', "pwd\t\t\t\t:\t\t\t\t", "token_of_the_service_account_in_the_other_region = ", "Authorization:      Bearer      ", "old-pwd\n      =\n      ", "pwd          '"]
    for name in names:
        text = f"x = 1\n{name}{secret}\n"
        assert [text[s:e] for s, e, _ in secrets.novel_spans(text, [])] == [secret], name
    began = time.perf_counter()
    for text in ("pass" * 100_000, "pass " * 100_000, "pwd" + " " * 400_000, "pwd =" + "\n \t" * 100_000, ("pwd" + " " * 400) * 1000, "token(" * 60_000):
        secrets.novel_spans(text, [])
    assert time.perf_counter() - began < 10


def test_secret_recall_and_precision_on_planted_keys():
    """Random keys behind sensitive names that no base pattern reads, and names, words and numbers in the same places."""
    rng = random.Random(17)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    names = ["private_key = ", "signing-key: ", "export DB_PWD=", 'credentials("', "Authorization: Bearer ", "encryption_key := ", "connection_string => "]
    plain = ["your_password_here", "process.env.DATABASE", "changeme_changeme_1", "get_private_key_From_file", "ConfigurationSettings.Default", "0000000000000000a", "default_example_value1"]
    found = missed = wrong = 0
    for _ in range(200):
        key = "".join(rng.choice(alphabet) for _ in range(rng.choice([24, 32, 40])))
        text = f"{prose(20, rng)}\n{rng.choice(names)}{key}\n{rng.choice(names)}{rng.choice(plain)}\n{prose(20, rng)}"
        spans = [text[s:e] for s, e, _ in secrets.novel_spans(text, secrets.base_spans(text))]
        found, missed, wrong = found + (key in spans), missed + (key not in spans), wrong + sum(x != key for x in spans)
    assert found >= 0.95 * (found + missed) and wrong <= 0.05 * found


def test_op7_digests_follow_the_spans(spark, tmp_path):
    secret = "k9Qw3xLm7RtZ2vYb8NcD5sFhJ4gPq6Wn1XyT0aZe"
    rows = [(0, None), (1, ""), (2, f"é password = '{secret}' AKIA{'A' * 16}deadbeefdeadbeef"), (3, f"private_key = {secret}\ntoken: abcdefabcdefabcdef")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in secrets.op7_secrets(spark, str(tmp_path)).collect()}
    for k, text in rows:
        base = plain_secrets(text or "")
        line = ",".join(f"{kind}:{s}:{e}" for s, e, kind in base)
        assert (got[k].n_assign, got[k].n_access, got[k].n_hex) == tuple(sum(x[2] == kind for x in base) for kind in secrets.KINDS) and got[k].base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert got[k].spans == line if k < 3 else got[k].spans.split(",") == [f"novel:14:{14 + len(secret)}", *line.split(",")] and got[k].n_novel == 1


def test_secrets_awkward(spark):
    assert secrets.find_secrets(docs(spark, AWKWARD)).count() == len(AWKWARD)
    assert secrets.find_secrets(docs(spark, AWKWARD).limit(0)).count() == 0


# ------------------------------------------------------------------ 8 exact duplicates


def plain_exact(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups["".join(c for c in t or "" if c not in SPACE)].append((-len(t or ""), i is None, i or 0, i))
    out = Counter()
    for norm, own in groups.items():
        best = min(own, key=lambda x: x[:3])
        for x in own:
            out[x[3], best[3], len(own), x[:3] == best[:3], hashlib.sha256(norm.encode()).hexdigest()] += 1
    return out


def test_exact_dedup_against_plain_python(spark):
    rng = random.Random(10)
    rows = AWKWARD + [(20 + k, rng.choice(["a b", "ab", "a  b ", "c", "c\n", "\x0b", "same text\there"]) + rng.choice(["", " "]), "s") for k in range(60)]
    got = exact_dedup.exact_dedup(docs(spark, rows).repartition(5)).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == plain_exact(rows)
    assert exact_dedup.exact_dedup(docs(spark, rows).limit(0)).count() == 0


def test_exact_dedup_takes_any_ids(spark):
    least, most = -(1 << 63), (1 << 63) - 1
    got = exact_dedup.exact_dedup(spark.createDataFrame([(least, "a b"), (most, "ab"), (0, "a b"), (5, "c")], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in got} == {(least, least, True), (most, least, False), (0, least, False), (5, 5, True)}
    named = exact_dedup.exact_dedup(spark.createDataFrame([("b", "x y"), ("a", "xy"), ("c", "x y"), (None, "x  y"), (None, None)], "doc_id string, text string")).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in named} == {("a", None, 4, False), ("b", None, 4, False), ("c", None, 4, False), (None, None, 4, True), (None, None, 1, True)}


def test_quotient_filters_merge_without_loss():
    rng = np.random.default_rng(3)
    for bits in (64, 57, 20):
        pool = rng.integers(0, 1 << min(bits, 62), 500, dtype=np.uint64) | (np.uint64(1) << np.uint64(bits - 1))
        parts = [rng.choice(pool, n) for n in (0, 1, 700, 3000)]
        filters = [exact_dedup.CountingQuotientFilter.build(p, bits) for p in parts]
        again = [exact_dedup.CountingQuotientFilter.decode(f.encode(), bits) for f in filters]
        for a, b in zip(filters, again, strict=True):
            assert (a.fingerprints == b.fingerprints).all() and (a.counts == b.counts).all()
        merged = exact_dedup.CountingQuotientFilter.merge(again)
        assert dict(zip(merged.fingerprints.tolist(), merged.counts.tolist())) == dict(Counter(np.concatenate(parts).tolist()))


# ------------------------------------------------------------------ 9 licenses


def test_licenses_are_found_with_spans(spark):
    mit = licenses.TEMPLATES["MIT"]
    noisy = mit.replace("without restriction", "with no restriction").replace("  ", " ").replace("merge, ", "").upper()
    rows = [(1, f"é {prose(30)}.\nLicensed under the Apache License, Version 2.0.\n{prose(9)}", "s"), (2, f"{prose(50)}\n/* {noisy} */ {prose(40)}", "s"), (3, prose(200), "s"), (4, "released under the license of the MIT", "s"), (5, "Released under\n the  MIT license", "s"), (6, "licensed under the", "s")]
    rows += [(7, " ".join([licenses.TEMPLATES["MIT-line"], prose(4), licenses.TEMPLATES["CC-BY-NC-4.0-line"]]), "s")]
    got = defaultdict(list)
    for r in licenses.find_licenses(docs(spark, rows + AWKWARD)).orderBy("start").collect():
        got[r.doc_id].append((r.license, dict((i, t) for i, t, _ in rows)[r.doc_id][r.start : r.end], r.coverage))
    assert set(got) == {1, 2, 5, 7}
    assert got[1] == [("Apache-2.0-line", "Licensed under the Apache License, Version 2.0", 1.0)]
    assert got[2][0][0] == "MIT" and got[2][0][2] > 0.95 and got[2][0][1].startswith("PERMISSION IS") and got[2][0][1].endswith("NONINFRINGEMENT")
    assert got[5] == [("MIT-line", "Released under\n the  MIT license", 1.0)]
    assert [x[0] for x in got[7]] == ["MIT-line", "CC-BY-NC-4.0-line"]
    assert licenses.find_licenses(docs(spark, rows).limit(0)).count() == 0


def longest_common(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_banded_alignment_is_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(60):
        a = [rng.randrange(6) for _ in range(rng.randint(1, 12))]
        b = [rng.randrange(6) for _ in range(rng.randint(1, 12))]
        matched, first, last = licenses.align(np.array(a, np.uint64), np.array(b, np.uint64), 0, band=13)
        assert matched == longest_common(a, b) and (not matched or 0 <= first <= last < len(b))


def test_repeated_lines_are_all_reported(spark):
    line = licenses.TEMPLATES["MIT-line"]
    rows = [(1, "\n".join([line] * 40), "s"), (2, f"é {line} x {line}\n{line}", "s"), (3, " ".join([licenses.TEMPLATES["MIT"]] * 3), "s")]
    got = defaultdict(list)
    for r in licenses.find_licenses(docs(spark, rows)).orderBy("start").collect():
        got[r.doc_id].append((r.license, rows[r.doc_id - 1][1][r.start : r.end]))
    assert [len(got[k]) for k in (1, 2, 3)] == [40, 3, 3] and {t for _, t in got[1]} == {t for _, t in got[2]} == {line[:-1]} and {n for n, _ in got[3]} == {"MIT"}


def test_candidates_lose_no_passage():
    """Index, winnowing and alignment against aligning every template everywhere, on texts with changed passages."""
    rng, index = random.Random(14), licenses.TemplateIndex(licenses.TEMPLATES)
    index.words = [w[:80] for w in index.words]  # shorter templates: the plain version aligns them at every word
    held = missed = 0
    for _ in range(25):
        text = []
        for _ in range(3):
            text += [rng.getrandbits(63) for _ in range(rng.randint(0, 40))]
            own = list(map(int, index.words[rng.randrange(len(index.words))]))
            for _ in range(rng.randint(0, len(own) // 6)):
                at = rng.randrange(len(own))
                own[at : at + 1] = rng.choice([[], [rng.getrandbits(63)], [own[at], rng.getrandbits(63)]])
            text += own
        words = np.array(text, np.uint64)
        got = licenses.match_words(words, licenses.shingle_hashes(words, licenses.GRAM), index, licenses.COVERAGE)
        taken = {x for _, a, b, _ in got for x in range(a, b + 1)}
        for t, template in enumerate(index.words):
            matched, first, last = licenses.align_all(template, words, np.arange(-5, len(words)))
            best = int(matched.argmax())
            if matched[best] >= (licenses.COVERAGE if len(template) > licenses.SHORT else 1) * len(template):
                held += 1
                missed += not taken & set(range(int(first[best]), int(last[best]) + 1))
    assert held >= 50 and missed == 0


def test_licenses_of_very_many_passages_are_close_to_linear():
    index, took = licenses.TemplateIndex(licenses.TEMPLATES), {}
    line = index.words[list(licenses.TEMPLATES).index("Apache-2.0-line")]
    for n in (200, 4000, 8000):
        words = np.concatenate([np.r_[line, np.array([k], np.uint64)] for k in range(n)])
        began = time.perf_counter()
        assert len(licenses.match_words(words, licenses.shingle_hashes(words, licenses.GRAM), index, licenses.COVERAGE)) == n
        took[n] = time.perf_counter() - began
    assert took[8000] <= 2.5 * took[4000] + 0.5


# ------------------------------------------------------------------ 10 mixing


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {s: 0.0 for s in sizes if sizes[s] == 0}
    while True:
        free = [s for s in sizes if s not in fixed]
        left = total - sum(fixed.values())
        targets = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        above = [s for s in free if targets[s] > most * sizes[s] * (1 + 1e-12)]
        if not above:
            return fixed | targets
        fixed |= {s: most * sizes[s] for s in above}


@pytest.mark.parametrize("seed", range(3))
def test_mixing_meets_targets(spark, seed):
    rng = random.Random(seed)
    rows = [(1000 + k, prose(rng.choice([0, 3, 30, 400]), rng), rng.choice(["a", "a", "a", "b", "c", "d", None, "é"] + ["tiny"] * (k == 5))) for k in range(200)] + AWKWARD
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = plain_targets({s: sizes[s] for s in {r[2] for r in rows}})
    frame = docs(spark, rows)
    got = mixing.mix_sources(frame).collect()
    again = mixing.mix_sources(frame.repartition(6)).collect()
    assert len(got) == len(rows) and Counter((r.doc_id, r.size, r.taken) for r in got) == Counter((r.doc_id, r.size, r.taken) for r in again)
    source_of = defaultdict(set)
    for i, _, s in rows:
        source_of[i].add(s)
    taken = Counter()
    for r in got:
        s = next(iter(source_of[r.doc_id]))
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s]) and 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    for s in want:
        assert taken[s] == pytest.approx(want[s], abs=1)
    texts = mixing.mixed_texts(frame)
    assert texts.columns == frame.columns
    words = Counter()
    for r in texts.collect():
        words[r.source] += len(r.text.split())
    assert {s: n for s, n in words.items() if n} == {s: n for s, n in taken.items() if n}


def test_mixing_empty(spark):
    assert mixing.mix_sources(docs(spark, AWKWARD).limit(0)).count() == 0
    assert mixing.mix_sources(docs(spark, [(1, "", "a"), (2, None, None)])).where("taken = 0 AND target = 0").count() == 2


def test_sources_beyond_the_clamp_are_reshared(spark):
    frame = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 5), ("d", 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    assert got == pytest.approx(plain_targets({"a": 10, "b": 1000, "c": 5, "d": 0})) and sqrt(got["a"] ** 2) == 30
