"""The stages one by one against brute force, and the whole on a small table."""

import os
from collections import Counter

import cases
import pytest
import test_contamination
import test_simhash
from test_quality import LABELS

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = cases.clashing(cases.documents(spark, n=150))
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(100)]
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    items = [(1, docs.filter("doc_id = 7").first().text), (2, "stone field")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_in_order():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "SimHash near-dedup", "benchmark decontamination",
                     "mixing sources to target weights", "sharding"]


def test_each_stage_on_awkward_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for number, stage in enumerate(stages):
        out = stage(spark, docs, folder)
        before, after = cases.rows_of(docs), cases.rows_of(out.select([f"`{c}`" for c in docs.columns]))
        texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
        if number < 4:
            assert out.columns == docs.columns
            assert set(after) <= set(before)
        if number == 0:
            assert len(after) > 0.9 * sum(bool((t or "").strip()) for _, t in texts)
        if number == 1:
            prints = [test_simhash.brute_print(r["text"]) for r in out.collect()]
            assert all((a ^ b).bit_count() > 4 for i, a in enumerate(prints) for b in prints[:i])
        if number == 2:
            clean = [i for i, t in texts if not test_contamination.brute(t, items)[1]]
            assert sorted(map(repr, clean)) == sorted(repr(r["doc_id"]) for r in out.collect())
            assert 7 not in clean
        if number == 3:
            assert max(Counter(after).values()) <= 2
        if number == 4:
            counts = Counter(r["shard"] for r in out.collect())
            assert max(counts.values()) - min(counts.values()) <= 1 and after == before
        path = f"{folder}/stage{number}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_whole_run(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    again = corpus_pipeline.run(spark, FOLDER).collect()
    assert rows and sorted(map(tuple, rows)) == sorted(map(tuple, again))
