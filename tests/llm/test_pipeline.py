import random

import corpus_pipeline as C
from trendspark.llm.common import saved

from .helpers import frame, near, odd_rows, table_folder, words
from .test_quality import corpus


def test_stages_keep_the_columns_and_their_decisions_take_effect(spark, tmp_path):
    rows, labels = corpus(240)
    copy = next(t for i, t in rows if i == 3)
    passage = words(80, 9001)
    rows += [(1000, copy), (1001, copy), (1002, words(100, 9002) + " " + passage + " " + words(90, 9003)), (1003, words(60, 9004) + " " + passage),
             (1004, words(60, 9005) + ' token = "' + "0a1b2c3d4e5f60718293" * 2 + '" ' + words(30, 9006))]
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    folder = table_folder(spark, tmp_path, documents=frame(spark, rows), labels=labelled)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    truth = {i: q for i, q, _ in labels}
    out = {}
    for name, stage in C.STAGES:
        docs = saved(stage(spark, docs, folder), "test")
        out[name] = docs
        if name != "best-fit packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    good = {r.doc_id for r in out["quality classifier"].collect()}
    assert sum(truth[i] for i in good if i in truth) >= 0.95 * sum(truth.values())
    assert sum(1 - truth[i] for i in good if i in truth) <= 0.2 * (len(truth) - sum(truth.values()))
    one = {r.doc_id: r for r in out["near duplicates"].collect()}
    left = [(i, t) for i, t in rows if i in good]
    assert set(one) == {c for _, c in near(left, 5).values()}
    cut = {r.doc_id: r for r in out["suffix-array dedup"].collect()}
    assert set(cut) == set(one) and passage not in cut[1002].text and passage not in cut[1003].text
    assert all(r.n_chars == len(r.text) for r in cut.values())
    clean = {r.doc_id: r.text for r in out["secret scan"].collect()}
    assert set(clean) == set(cut) and "<secret>" in clean[1004] and "0a1b2c3d" not in clean[1004]
    assert {r.doc_id for r in out["best-fit packing"].select("doc_id").collect()} == set(clean)


def test_run_on_odd_rows_and_empty_tables(spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    folder = table_folder(spark, tmp_path / "odd", documents=frame(spark, odd_rows(), clash=True), labels=labels)
    assert C.run(spark, folder).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    folder = table_folder(spark, tmp_path / "none", documents=frame(spark, []), labels=labels)
    assert C.run(spark, folder).count() == 0
