"""The pipeline: its stages take effect and keep the columns of documents."""

from conftest import SF

import corpus_pipeline


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        counts.append(docs.count())
        if k < 4:
            assert docs.columns == columns
            assert docs.where("n_chars <> length(text)").count() == 0
    assert counts[0] > counts[1] == counts[2] > counts[3] and counts[5] >= counts[4] > 0
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(docs.columns)


def test_clean_labelled_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = corpus_pipeline.quality_stage(spark, docs, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    good, bad = labels.where("quality = 1"), labels.where("quality = 0")
    assert good.join(kept, "doc_id", "left_semi").count() >= 0.99 * good.count()
    assert bad.join(kept, "doc_id", "left_semi").count() <= 0.05 * bad.count()


def test_near_stage_keeps_one_of_each_group(spark):
    text = " ".join(f"word{i}" for i in range(50))
    rows = [(3, text), (1, text + " more"), (2, text), (4, "other"), (None, text), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in corpus_pipeline.near_stage(spark, docs, SF).collect()) == ["1", "4", "5", "None"]


def test_stages_with_awkward_rows(spark, tmp_path):
    """Null, empty and long texts, repeated rows and ids, null ids and sources, and columns with the names of inner ones."""
    schema = "doc_id long, text string, source string, n_chars long, gone_id long, id string, row string, n int, bucket long, component string, score double"
    text = " ".join(f"wort{i}" for i in range(40))
    rows = [(1, None, "a"), (2, "", None), (3, text, "a"), (3, text, "a"), (4, text, None), (None, text, "b"), (5, "x " * 30_000, "b"), (6, "e\u0301 \n  東京 \t z", "b")]
    frame = spark.createDataFrame([(*r, len(r[1] or ""), 1, "x", "y", 2, 3, "z", 0.5) for r in rows], schema)
    spark.createDataFrame([(3, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, docs in (("rows", frame), ("none", frame.limit(0))):
        counts = []
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = str(tmp_path / f"{name}-{k}")
            stage(spark, docs, str(tmp_path)).write.parquet(out)
            docs = spark.read.parquet(out)
            counts.append(docs.count())
            assert k == 4 or docs.columns == frame.columns
        assert counts[2] == (7 if counts[0] else 0) and (counts[4] > 0) == (counts[0] > 0)


def test_a_cut_copy_keeps_its_white_space(spark):
    text = "".join(f"w{i}{' ' if i % 3 else chr(10) * 2}" for i in range(200))
    docs = spark.createDataFrame([(k, f"{k}\t{text}", s, 0) for k, s in enumerate("aabbcc")], "doc_id long, text string, source string, n_chars long")
    mixed = corpus_pipeline.mixing_stage(spark, docs, SF).collect()
    whole = {r.doc_id: r.text for r in docs.collect()}
    cut = [r for r in mixed if r.text != whole[r.doc_id]]
    assert cut and all(whole[r.doc_id].startswith(r.text) and r.text.split() == whole[r.doc_id].split()[: len(r.text.split())] and r.n_chars == len(r.text) for r in mixed)
