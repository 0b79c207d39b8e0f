"""Dedup, training rows, spans, question-answer work, store, sources, streaming."""

import json
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import dedup, qa, spans, stats, store, training
from corpusmill.sources import files, rest


def test_exact_dedup_is_per_source_and_keeps_first(spark):
    rows = [("s", "b", "A  x"), ("s", "a", "a x"), ("t", "c", "a x"), ("s", "d", None), ("s", "e", " ")]
    frame = spark.createDataFrame(rows, "source string, doc_id string, text string")
    want = {("s", "a"), ("t", "c"), ("s", "d")}
    for n in (1, 7):
        assert {(r.source, r.doc_id) for r in dedup.exact_dedup(frame.repartition(n)).collect()} == want
    stats_ = {r.source: (r.total, r.exact_dups, r.kept) for r in dedup.dedup_stats(frame, near=False).collect()}
    assert stats_ == {"s": (4, 2, 2), "t": (1, 0, 1)}


def greedy(rows):
    """The plain rule over band hashes, in key order within a source."""
    a, b = dedup._coefficients()
    kept, out = {}, {}
    for source, key, text in sorted(rows):
        bands = [(source, i, int(h)) for i, h in enumerate(dedup.band_hashes(" ".join(text.split()).lower(), a, b))]
        out[source, key] = any(x in kept for x in bands)
        if not out[source, key]:
            kept.update(dict.fromkeys(bands))
    return out


def test_near_dedup_is_the_greedy_rule(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(300)) for _ in range(4)]
    rows = []
    for key in range(60):
        t = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 3, 8, 25])):
            t[rng.randrange(len(t))] = rng.choice("xyz")
        rows.append((f"s{key % 2}", key, "".join(t)))
    frame = spark.createDataFrame(rows, "source string, doc_id int, text string")
    want = greedy(rows)
    assert any(want.values()) and not all(want.values())
    for n in (1, 5):
        got = {(r.source, r.doc_id): r.is_near_duplicate for r in dedup.near_marks(frame.repartition(n)).collect()}
        assert got == want


def test_similar_texts_collide(spark):
    a, b = dedup._coefficients()
    rng = random.Random(1)
    hits = 0
    for _ in range(40):
        t = "".join(rng.choice("abcdefghijklmnop") for _ in range(600))
        u = t[:300] + "#" + t[301:]
        hits += bool(set(dedup.band_hashes(t, a, b).tolist()) & set(dedup.band_hashes(u, a, b).tolist()))
    assert hits >= 38


def test_split_and_upsample(spark):
    frame = spark.createDataFrame([("court", "abc"), ("kolzchut", "k1")], "source string, doc_id string")
    rows = training.with_split(frame)
    assert rows.where("source = 'court'").first().split == "train"
    up = training.upsample(rows.withColumn("split", F.when(F.col("source") == "court", "eval").otherwise("train")))
    assert sorted((r.source, r.copy) for r in up.collect()) == [("court", 1), *(("kolzchut", k) for k in range(1, 6))]


def test_shuffle_does_not_depend_on_partitions(spark):
    frame = spark.range(50)
    assert [r.id for r in training.shuffled(frame.repartition(1), "id").collect()] == [r.id for r in training.shuffled(frame.repartition(9), "id").collect()] != list(range(50))


def test_quantiles_by_index(spark):
    frame = spark.createDataFrame([("s", v) for v in range(10)] + [("t", 5)], "source string, v long")
    got = {r.source: (r.median, r.p10, r.p90, r.mean) for r in stats.index_quantiles(frame, "v").collect()}
    assert got == {"s": (5, 1, 9, 4), "t": (5, 5, 5, 5)}


def test_chat_and_answer(spark):
    turns = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "a")], "conv_id int, turn int, role string, text string")
    assert training.chat_conversations(turns).first().text == "[INST] q [/INST]a</s>"
    frame = spark.createDataFrame([("[INST] q [/INST] a \n",), ("none",)], "t string")
    assert [r[0] for r in frame.select(training.answer_of(F.col("t"))).collect()] == ["a", "none"]


def plain_merge(spans):
    out = []
    for s, e in sorted(set(spans)):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def test_many_spans_against_plain_python(spark):
    rng = random.Random(3)
    rows = []
    for k in range(60):
        text = "".join(rng.choice("ab é\n東") for _ in range(rng.choice([0, 5, 3000])))
        n = rng.choice([0, 1, 17, 300, 900])
        rows.append((k, text, [(s := rng.randrange(len(text) + 1), min(len(text), s + rng.choice([0, 1, 2, 4, 30]))) for _ in range(n)]))
    rows.append((99, "x" * 2000, [(i * 4, i * 4 + 2) for i in range(400)] + [(100, 1500)]))
    frame = spark.createDataFrame(rows, "k int, t string, x " + spans.SPANS)
    merged = spans.merge_spans(F.col("x"))
    for r in frame.select("k", merged.alias("m"), spans.replace_spans(F.col("t"), merged, "#").alias("r")).collect():
        _, text, own = next(x for x in rows if x[0] == r.k)
        want = plain_merge(own)
        assert [tuple(x) for x in r.m] == want
        for s, e in reversed(want):
            text = text[:s] + "#" + text[e:] if len(text[s:e].strip()) >= 2 else text
        assert r.r == text


def test_spans(spark):
    one = spark.createDataFrame([("abcdefgh", [(1, 3), (3, 5), (7, 8), (1, 3)])], "t string, x array<struct<s:int,e:int>>")
    row = one.select(spans.merge_spans(F.col("x")).alias("m"), spans.replace_spans(F.col("t"), spans.merge_spans(F.col("x"))).alias("r")).first()
    assert [(m.s, m.e) for m in row.m] == [(1, 5), (7, 8)] and row.r == "a[שם]fgh"
    labels = ["O", "I-PER", "B-PER", "I-PER", "B-PER", "O", "I-PER", "B-PERSON"]
    tokens = [(1, i, 10 * i + 1, 10 * i + 5, x) for i, x in enumerate(labels)] + [(1, 8, 0, 0, "I-PER"), (1, 9, 91, 95, "I-PER")]
    got = spans.decode_bio(spark.createDataFrame(tokens, "doc_id int, idx int, start int, end int, label string"))
    assert sorted((r.s, r.e) for r in got.collect()) == [(21, 35), (41, 45), (71, 75)]
    sizes = spark.createDataFrame([(0,), (1,), (510,), (511,), (730,), (731,)], "n int")
    assert [r[0] for r in sizes.select(spans.window_starts(F.col("n"))).collect()] == [[], [0], [0], [0, 110], [0, 110, 220], [0, 110, 220, 330]]


def test_replies(spark):
    good = json.dumps([{"question": " q ", "answer": "a" * 21}, {"question": "q", "answer": "a" * 20}, {"question": "", "answer": "a" * 30}])
    rows = [(1, good), (2, f"```json\n{good}\n```"), (3, f"json {good}"), (4, "no"), (5, None)]
    frame = spark.createDataFrame(rows, "doc_id int, reply string")
    got = qa.parse_replies(frame).collect()
    assert sorted((r.doc_id, r.question, len(r.answer)) for r in got) == [(1, "q", 21), (2, "q", 21), (3, "q", 21)]
    assert [x.role for x in got[0].conversations] == ["user", "assistant"]


def test_prompt_is_cut_only_if_longer(spark):
    frame = spark.createDataFrame([("x" * 8000,), ("x" * 8001,)], "t string")
    a, b = (r[0] for r in frame.select(qa.prompt_for(F.col("t"))).collect())
    assert "x" * 8000 + "\n" in a and "x" * 8000 + "..." in b and '{"question"' in a


def test_store(spark):
    frame = spark.createDataFrame([("k", 1, "a"), ("k", 3, "c"), ("k", 2, "b"), ("m", 1, None)], "k string, o int, v string")
    assert {r.k: r.v for r in store.latest(frame, "k", "o").collect()} == {"k": "c", "m": None}
    rows = spark.range(97).withColumnRenamed("id", "x").repartition(5)
    assert sorted(r.x for r in store.slice_rows(rows, 10, 20, "x").collect()) == list(range(10, 20))
    ids = spark.createDataFrame([("", "b"), (None, "c"), ("a", "d")], "p string, q string")
    assert [r[0] for r in ids.select(store.fallback_id("gc_", F.col("p"), F.col("q"))).collect()] == ["gc_b", "gc_c", "gc_a"]


def test_json_store(spark, tmp_path):
    folder = tmp_path / "court"
    folder.mkdir()
    (folder / "b.json").write_text(json.dumps({"text": "שלום", "title": "t"}, indent=2, ensure_ascii=False), encoding="utf-8")
    (folder / "a.json").write_text("{broken")
    (folder / "c.json").write_bytes(b'{"text": "\xff\xfe"}')
    got = files.read_sources(spark, str(tmp_path), ["court"]).collect()
    assert [(r.doc_id, r.text) for r in got] == [("court/b", "שלום")]
    out = spark.createDataFrame([("a", "train"), ("b", "eval")], "text string, split string")
    files.write_training(out, str(tmp_path / "out"))
    assert [r.text for r in files.read_jsonl(spark, str(tmp_path / "out/eval")).collect()] == ["b"]


def test_offset_source(spark):
    def fetch(skip, top):
        return [{"id": i, "name": f"n{i}"} for i in range(skip, min(skip + top, 23))]

    rest.register(spark, rest.offset_source("laws", fetch, "id long, name string", page=5, parallel=3))
    assert sorted(r.id for r in spark.read.format("laws").load().collect()) == list(range(23))


def test_cursor_source_and_batches(spark, tmp_path):
    from corpusmill.streaming import ingest

    def fetch(cursor):
        at = int(cursor or 0)
        return [{"title": f"t{at}"}, {"title": f"t{at + 1}"}], str(at + 2) if at < 4 else None

    rest.register(spark, rest.cursor_source("titles", fetch, "title string"))
    stream = spark.readStream.format("titles").load()
    found = ingest.append_batches(stream, str(tmp_path / "out"), str(tmp_path / "check"), processingTime="0 seconds")
    try:
        for _ in range(6):
            found.processAllAvailable()
    finally:
        found.stop()
    assert sorted({r.title for r in spark.read.parquet(str(tmp_path / "out")).collect()}) == [f"t{k}" for k in range(6)]


def test_client_wrappers():
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise ValueError("no")
        return "ok"

    assert rest.retrying(flaky, sleep=waits.append)() == "ok" and waits == [2.0, 4.0]
    with pytest.raises(rest.RateLimited):
        rest.status_checked(lambda: (429, ""))()
    with pytest.raises(RuntimeError):
        rest.status_checked(lambda: (500, ""))()
    assert rest.throttled(lambda: 5, 1.5, waits.append)() == 5 and waits[-1] == 1.5


def test_stream_dedup(spark, tmp_path):
    from datetime import datetime

    from corpusmill.streaming import ingest

    rows = [("s", "A b", datetime(2024, 1, 1, 0)), ("s", "a  b", datetime(2024, 1, 1, 1)), ("t", "a b", datetime(2024, 1, 1, 1))]
    frame = spark.createDataFrame(rows, "source string, text string, ts timestamp")
    frame.write.parquet(str(tmp_path / "in"))
    stream = ingest.document_stream(spark, str(tmp_path / "in"), frame.schema)
    done = ingest.append_batches(ingest.dedup_stream(stream, "ts"), str(tmp_path / "out"), str(tmp_path / "check"))
    done.awaitTermination(60)
    assert sorted(r.source for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["s", "t"]


def test_pipeline_command_line(spark, tmp_path, capsys):
    from conftest import SF

    from corpusmill.plans import pipeline

    pipeline.main(["--raw", f"{SF}/documents.parquet", "--out", str(tmp_path), "--profile", "latin", "--no-near", "--step", "format"])
    assert spark.read.json(str(tmp_path / "training/train")).count() > 0
