"""Raw records: court scans, laws, listings by ranges, replies, and raw folders from end to end."""

import json

import pytest

from corpusmill.operators import qa, records, store
from corpusmill.sources import files, rest


def test_listing_rules():
    """Saves, pauses and refusals of one range, then ranges in turn."""
    waits, saved, titles = [], [], []
    pages = {None: (["a", "b"], "1")} | {str(k): ([f"t{k}"], str(k + 1) if k < 17 else None) for k in range(1, 18)}
    save = lambda titles, cursor: saved.append((len(titles), cursor))
    assert rest.read_range(lambda cursor: pages[cursor], titles, save, delay=1, cooldown=60, sleep=waits.append)
    assert titles == ["a", "b", *[f"t{k}" for k in range(1, 18)]] and [c for _, c in saved] == ["5", "10", "15"] and waits == [1] * 14 + [60] + [1] * 2
    asked = []

    def refusing(cursor):
        asked.append(cursor)
        if len(asked) in (2, 4, 5):
            raise rest.RateLimited("slow")
        return ["x"], "next"

    waits.clear()
    assert not rest.read_range(refusing, titles, save, sleep=waits.append) and len(asked) == 5 and waits == [1.0, 60.0, 1.0, 60.0]
    ranges = {None: (lambda cursor: (["never"], None)), "k": (lambda cursor: (["b", "m", "m"], None)), "z": (lambda cursor: (["never"], None))}
    assert rest.read_ranges([None, "k", "z"], ranges.get, ["b", "a"], save, sleep=waits.append) == ["b", "a", "m"]
    assert rest.read_ranges([None, "k"], ranges.get, [], save, sleep=waits.append) == ["never"]


def test_titles_of_listings(spark):
    frame = lambda *titles: spark.createDataFrame([(t,) for t in titles], "title string")

    def lost():
        raise OSError("no listing")

    got, failed = store.sorted_titles(spark, {"a": lambda: frame("c", "a"), "b": lost, "c": lambda: frame("b", "a")})
    assert [r.title for r in got.collect()] == ["a", "b", "c"] and failed == {"b": "OSError: no listing"}
    assert store.sorted_titles(spark, {"b": lost})[0].count() == 0


def test_records_take_the_columns_that_are_there(spark):
    rows = spark.createDataFrame([(0, "x" * 250, None, "n"), (1, "short", "c", "n"), (2, "y" * 200, "", ""), (3, "z" * 200, "c3", None)], "o int, text string, case_id string, case_nbr string")
    got = {r.store_id: r for r in records.supreme_judgments(rows, "o").collect()}
    assert set(got) == {"sc_n", "sc_1", "sc_c3"} and got["sc_n"].case_num == "n" and got["sc_c3"].case_num is None and got["sc_1"].judges == [] and got["sc_1"].title == ""
    laws = spark.createDataFrame([("1", None), ("2", ""), (None, "t")], "LawID string, Name string")
    assert [(r.store_id, r.text, json.loads(r.raw_fields)) for r in records.law_documents(laws).collect()] == [("t", "שם החוק: t", {"LawID": None, "Name": "t"})]


def test_null_questions_void_a_reply(spark):
    long = "a" * 30
    replies = [json.dumps([{"question": "q", "answer": long}, {"answer": long}]), json.dumps([{"question": "q", "answer": long}, {"question": None, "answer": long}]), json.dumps([{"question": "q", "answer": None}]), "[]", "no json"]
    got = qa.parse_replies(spark.createDataFrame(list(enumerate(replies)), "i int, reply string")).collect()
    assert [(r.i, r.question) for r in got] == [(0, "q")]


def test_texts_are_files(spark, tmp_path):
    frame = spark.createDataFrame([("a b.txt", "one\n"), ("ü.txt", None)], "file_name string, text string")
    for _ in range(2):
        files.write_texts(frame, str(tmp_path / "out"))
    assert {p.name: p.read_text() for p in (tmp_path / "out").iterdir()} == {"a b.txt": "one\n", "ü.txt": ""}


def test_pipeline_on_raw_folders(spark, tmp_path, capsys):
    """Every source by its own rules, from JSON documents to clean ones, and on to training rows."""
    from corpusmill.plans import pipeline

    words = " ".join(f"מילה{i}" for i in range(150))
    raw = {
        "court/a": {"text": f"  {words}  \n\n\n\n סוף", "title": "t", "judges": ["x", "y"], "year": 2001, "case_id": "7"},
        "court/b": {"text": f"{words} b", "judges": "one judge"},
        "court/c": {"text": ""},
        "kolzchut/p": {"title": "p", "wikitext": "{{a{{b}}}}'''" + words + "''' [[x|y]] ==h==", "text": "not this", "categories": ["k1", "k2"], "url": "u"},
        "kolzchut/q": {"title": "q", "text": "{{x}} '''bold''' [[a|b]]"},
        "wikisource_laws/w": {"title": None, "wikitext": "", "text": f"<b>{words}</b> חוק"},
        "knesset/k": {"title": "k", "text": words},
    }
    for name, doc in raw.items():
        path = tmp_path / "raw" / f"{name}.json"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(doc, ensure_ascii=False), encoding="utf-8")
    out = str(tmp_path / "out")
    pipeline.main(["--raw", str(tmp_path / "raw"), "--out", out, "--step", "clean"])
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["clean"]
    clean = {r.doc_id: r for r in spark.read.parquet(f"{out}/clean").collect()}
    assert set(clean) == {"court/a", "court/b", "kolzchut/p", "kolzchut/q", "wikisource_laws/w"}
    assert clean["court/a"].text == f"{words}\n\nסוף" and json.loads(clean["court/a"].meta) == {"case_id": "7", "year": "2001", "judges": ["x", "y"]} and json.loads(clean["court/b"].meta) == {"judges": "one judge"}
    assert clean["kolzchut/p"].text == f"{words} y h" and json.loads(clean["kolzchut/p"].meta) == {"categories": ["k1", "k2"], "url": "u"}
    assert clean["kolzchut/q"].text == "bold b" and clean["wikisource_laws/w"].source == "wikisource" and clean["wikisource_laws/w"].title == ""
    pipeline.main(["--raw", str(tmp_path / "raw"), "--out", out, "--step", "all", "--no-near"])
    rows = [r.text for split in ("train", "eval") for r in spark.read.schema("text string").json(f"{out}/training/{split}").collect()]
    assert rows.count(f"{words} y h") in (1, 5) and "bold b" not in rows and len({*rows}) == spark.read.parquet(f"{out}/dedup").count() == 4


def test_folders_that_are_not_there(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_sources(spark, str(tmp_path), list(files.RAW_SOURCES))
