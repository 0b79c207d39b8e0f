"""Golden rows and plain-Python specifications of cleaning, scrubbing and signals."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from corpusmill.config import HEBREW_PROFILE, LATIN_PROFILE
from corpusmill.functions import scrub, signals, text


def apply(spark, column, rows):
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, text string")
    return [r[0] for r in frame.select(column.alias("x"), "i").orderBy("i").collect()]


def test_clean_text(spark):
    rows = ["בית־דין", "תשל״א", "אabcב", "a\n \n \n \nb", " x​\x07   y\r\n", "é"]
    assert apply(spark, text.clean_text(F.col("text")), rows) == ["ביתדין", 'תשל"א', "א abc ב", "a\n\n \n\nb", "x y", "é"]


def test_wikitext(spark):
    rows = ["x{{a{{b}}c}}y", "[[a|b|c]]", "p [http://x.y] q", "p [http://x.y z] q", "===h===", "{| a\nb |}c", "'''''x'''''", "{{a}} {{b{{c{{d}}}}}} {{open"]
    assert apply(spark, text.clean_wikitext(F.col("text")), rows) == ["xy", "b|c", "p  q", "p z q", "=h=", "c", "x", "  {{open"]


def test_router(spark):
    rows = [(1, "knesset", "a", None), (2, "court", " a  b ", None), (3, "court", "", None), (4, "kolzchut", "plain", ""), (5, "wikisource_laws", "t", "[[x|y]]"), (6, "other", "a", None)]
    frame = spark.createDataFrame(rows, "doc_id int, source_dir string, text string, wikitext string")
    got = {r.doc_id: (r.source, r.text) for r in text.clean_documents(frame).collect()}
    assert got == {2: ("court", "a b"), 4: ("kolzchut", "plain"), 5: ("wikisource", "y")}


def test_scrub(spark):
    rows = ["031234567", "03-1234567", "052-123-4567", " +972-3-123-4567", "tel+972-3-123-4567", "ב123456789", "a b@c.de f", "1234 5678-9012 3456", "123-456-789"]
    want = ["[מספר_זהות]", "[טלפון]", "[טלפון]", " +972-3-123-4567", "tel[טלפון]", "ב123456789", "a [אימייל] f", "[מספר_כרטיס]", "[מספר_זהות]"]
    assert apply(spark, scrub.scrub(F.col("text")), rows) == want
    assert apply(spark, scrub.scrub(F.col("text"), strict=True), rows[:1] + rows[3:4]) == ["[טלפון]", " [טלפון]"]


def plain_signals(t):
    words, lines = t.split(), t.split("\n")
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    rep = min(sum(grams.count(g) - 1 for g in set(grams)) * 5 / len(words), 1.0) if len(words) >= 5 else 0.0
    total = sum(map(len, lines))
    own = [x for x in lines if x.strip()]
    dup = (sum(map(len, own)) - sum(map(len, set(own)))) / total if total else 0.0
    short = sum(len(x.strip()) < 30 for x in own) / len(own) if own else 1.0
    alpha = sum(c.isalpha() for c in t) / len(t) if t else 0.0
    return len(words), alpha, rep, dup, short


def test_signals_equal_plain_python(spark):
    rng = random.Random(5)
    rows = ["", "\n\n", "a b c d", "-----\n12\nabc", *("".join(rng.choice(["a ", "bb ", "\n", "שלום ", "7", "x" * 31 + "\n", "a b a b "]) for _ in range(rng.randint(1, 60))) for _ in range(80))]
    got = list(zip(*[apply(spark, c(F.col("text")), rows) for c in (signals.word_count, signals.alpha_ratio, signals.ngram_repetition, signals.duplicate_line_ratio, signals.short_line_ratio)], strict=True))
    for own, t in zip(got, rows, strict=True):
        assert own == pytest.approx(plain_signals(t)), t


def test_first_failure(spark):
    rows = ["1 2 3", " ".join(["12345"] * 120), " ".join(f"word{i}abc" for i in range(120)), " ".join(f"מילה{'אבגדהוזחטי'[i % 10]}{'כלמנסעפצקר'[i // 10 % 10]}{'שת'[i // 100]}" for i in range(150))]
    assert apply(spark, signals.reject_reason(F.col("text"), HEBREW_PROFILE), rows) == ["min_length", "alpha_ratio", "hebrew_ratio", None]
    assert apply(spark, signals.reject_reason(F.col("text"), LATIN_PROFILE), rows) == ["min_length", "alpha_ratio", None, "latin_ratio"]


def test_boilerplate_counts_overlaps_twice(spark):
    rows = ["---\n" + "x" * 6, "12\n---\nabcd", "בבית המשפט x בשבתו"]
    assert apply(spark, signals.boilerplate_ratio(F.col("text")), rows) == pytest.approx([0.3, 5 / 11, 1.0])


def test_law_text(spark):
    frame = spark.createDataFrame([("7", None, "law", "", "x")], "LawID string, Name string, TypeDesc string, PublicationDate string, Text string")
    row = text.law_text(frame).first()
    assert (row.law_id, row.title, row.text) == ("7", None, "סוג: law\nText: x")


def test_no_regex_left_behind():
    assert re.fullmatch(HEBREW_PROFILE.script, "א") and not re.fullmatch(HEBREW_PROFILE.script, "a")


def test_templates_go_by_nesting_and_not_by_number(spark):
    texts = ["{{a}}" * 3000, "{" * 400 + "x" + "}" * 400, "{{{a}}{b}}", "{{a{{b}}c}} {{", "}}{{", "{{" * 2000]
    want = []
    for t in texts:
        while (less := re.sub(r"\{\{[^{}]*\}\}", "", t)) != t:
            t = less
        want.append(t)
    began = time.perf_counter()
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", text.drop_templates(F.col("t")).alias("t")).orderBy("i").collect()
    assert [r.t for r in got] == want and time.perf_counter() - began < 60
