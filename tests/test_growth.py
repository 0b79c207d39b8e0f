"""What keeps the costs of whole texts down: each step once for a text, shared work once for many, bounded batches. Results stay."""

import random
from functools import reduce

import numpy as np
from pyspark.sql import functions as F

from corpusmill.config import BOILERPLATE, HEBREW, HEBREW_PROFILE, LATIN_PROFILE, SCRUB_RULES, STRICT_SCRUB_RULES, FilterConfig
from corpusmill.functions import scrub, signals, text
from corpusmill.operators import dedup, qa
from corpusmill.plans import pipeline

ODD = ["", " ", "a", "\n", "  x　", "a \n \n\t\nb\n\n\n\nc ", "בית־דין תשל״א ׳x׳ אabcב xא", "é ̈́ 가 ﻿z\x00\x85‎", "a\tb  c   d", "\n\n\n", "x" * 3000 + "  ", "٠" * 9 + " end"]
PRIVATE = ["031234567", "a@b.co", "tel+972-3-123-4567", "052-123-4567 03-1234567", "123-456-789", "1234 5678 9012 3456", "12345678", "12 34 56 78 9 a@b", "x +972 3 123 4567", "1" * 8 + "--1", "123456789@x.org 03-1234567"]


def once(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")


def test_a_text_is_cleaned_once(spark):
    """one Python evaluation in all, where the filter behind it had its own, and each route too."""
    rows = spark.createDataFrame([(1, "court", "a"), (2, "kolzchut", "[[a|b]]"), (3, "knesset", "c"), (4, "court", " ")], "doc_id int, source_dir string, text string")
    routed = text.clean_documents(rows)
    assert once(routed) == 1 and sorted((r.doc_id, r.text) for r in routed.collect()) == [(1, "a"), (2, "b")]
    plain = pipeline.clean_step(rows.drop("source_dir"))
    assert once(plain) == 1 and sorted(r.doc_id for r in plain.collect()) == [1, 2, 3]


def test_cleaning_is_the_plain_chain(spark):
    """clean_text and normalised against their steps one by one, unguarded."""
    from corpusmill.config import CONTROL, NIQQUD, PUNCTUATION, ZERO_WIDTH
    from corpusmill.functions.columns import strip

    rng = random.Random(5)
    rows = ODD + ["".join(rng.choice("a אְ׳״‏\x1f\x7f\t\n\r é́ñ-") for _ in range(rng.randrange(40))) for _ in range(500)]
    frame = spark.createDataFrame([(t,) for t in rows], "t string")
    plain = reduce(lambda t, p: F.regexp_replace(t, p, ""), (NIQQUD, ZERO_WIDTH, CONTROL), text._nfc(F.col("t")))
    plain = F.translate(plain, "".join(PUNCTUATION), "".join(PUNCTUATION.values()))
    for pattern, to in ((f"({HEBREW})([a-zA-Z])", "$1 $2"), (f"([a-zA-Z])({HEBREW})", "$1 $2"), (r"(?U)[^\S\n]+", " "), (r"\n[ \t]+\n", "\n\n"), (r"\n{3,}", "\n\n")):
        plain = F.regexp_replace(plain, pattern, to)
    got = frame.select(text.clean_text(F.col("t")).alias("a"), strip(plain).alias("b"), dedup.normalised(F.col("t")).alias("c"), F.lower(strip(F.regexp_replace("t", r"(?U)\s+", " "))).alias("d")).collect()
    assert [r.a for r in got] == [r.b for r in got] and [r.c for r in got] == [r.d for r in got]


def test_guards_leave_scrubbing_and_signals_alone(spark):
    rng = random.Random(6)
    rows = ODD + PRIVATE + ["בבית המשפט x בשבתו", "הוגש ביום 1.2", "המזכירות תשלח", "עמוד 1 מתוך 2", "---\n12\n"]
    rows += [" ".join(rng.choice(rows[:28]) for _ in range(6)) for _ in range(200)]
    frame = spark.createDataFrame([(t,) for t in rows], "t string")
    t = F.col("t")
    for strict, rules in ((False, SCRUB_RULES), (True, STRICT_SCRUB_RULES)):
        for r in frame.select(scrub.scrub(t, strict).alias("a"), reduce(lambda x, rule: F.regexp_replace(x, rule[0], F.lit(rule[1])), rules, t).alias("b")).collect():
            assert r.a == r.b
    matched = sum((F.length(t) - F.length(F.regexp_replace(t, p, "")) for p in BOILERPLATE), F.lit(0))
    for r in frame.where("t <> ''").select(signals.boilerplate_ratio(t).alias("a"), F.least(matched / F.length(t), F.lit(1.0)).alias("b")).collect():
        assert r.a == r.b
    for profile in (HEBREW_PROFILE, LATIN_PROFILE, FilterConfig(script="[a-zé]", letters="[a-z]")):
        letters, wanted = (F.length(t) - F.length(F.regexp_replace(t, f"{c}+", "")) for c in (profile.letters, profile.script))
        for r in frame.select(signals.script_ratio(t, profile).alias("a"), F.when(letters == 0, F.lit(0.0)).otherwise(wanted / letters).alias("b")).collect():
            assert r.a == r.b


def test_model_calls_are_in_bounded_batches(spark):
    """batches of 4 MB, whatever their rows; outcomes and order of keys as ever."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")

    def load():
        def ask(prompt):
            if prompt[0] in "ef":
                raise RuntimeError({"e": "429", "f": "lost"}[prompt[0]])
            return "[]" if prompt[0] == "a" else "no json"

        return ask

    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.concat(F.element_at(F.array(*map(F.lit, "aefz")), (F.col("id") % 4 + 1).cast("int")), F.repeat(F.lit("א"), 8000)).alias("prompt"))
    got = {r.doc_id: (r.reply, r.outcome, r.done) for r in qa.call_model(rows, load).collect()}
    want = [("[]", "ok", True), (None, "limited", False), (None, "failed", False), ("no json", "malformed", True)]
    assert got == {k: want[k % 4] for k in range(1000)}
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20


def test_texts_are_hashed_once(spark):
    """marks are joined from stored hashes; neither side reads texts again."""
    frame = spark.createDataFrame([("s", 1, "a b"), ("s", 2, "A  b"), (None, 3, "a b"), (None, 4, None)], "source string, doc_id int, text string")
    marks = dedup.exact_marks(frame)
    assert "sha2" not in marks._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.doc_id, r.is_duplicate) for r in marks.collect()) == [(1, False), (2, True), (3, False), (4, False)]
    assert {r.source: (r.total, r.exact_dups, r.near_dups, r.kept) for r in dedup.dedup_stats(frame).collect()} == {"s": (2, 1, 0, 1), None: (2, 0, 0, 2)}


def test_shared_shingles_are_hashed_once(spark, monkeypatch):
    """the same band hashes as text by text, in pieces too, with work by distinct shingles."""
    rng = random.Random(7)
    a, b = dedup._coefficients()
    texts = ["", "a", "abcd", "abcde", "é" * 700, "\ud800" * 7, *("".join(rng.choice("abc d") for _ in range(rng.randrange(400))) for _ in range(120))]
    want = np.array([dedup.band_hashes(t, a, b) for t in texts])
    for together in (1, 50, 3000, 1 << 20):
        monkeypatch.setattr(dedup, "TOGETHER", together)
        assert (dedup.bands_of(texts, a, b) == want).all()
    done, plain = [], dedup._permuted
    monkeypatch.setattr(dedup, "_permuted", lambda x, *more: (done.append(len(x)), plain(x, *more)))
    dedup.bands_of(texts, a, b)
    assert sum(done) < sum(len(dedup.shingle_hashes(t)) for t in texts) * dedup.BANDS * dedup.ROWS / 4
    assert dedup.bands_of([], a, b).shape == (0, dedup.BANDS)
