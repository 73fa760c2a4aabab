import cases
import pytest
from pyspark.sql import functions as F

from headway.llm import common, quality, simhash, substring, warc


def test_spread_join_is_an_inner_join(spark):
    facts = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 2500).alias("k"), F.col("id").alias("x")
    )
    table = facts.groupBy("k").agg(F.count("*").alias("n"), F.max("x").alias("m")).filter("k <> 11")
    want = cases.rows_of(facts.join(table, "k").select("k", "x", "n", "m"))
    assert cases.rows_of(common.spread_join(facts, table, "k", "n").select("k", "x", "n", "m")) == want
    assert common.spread_join(facts, table.limit(0), "k", "n").count() == 0


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_without_by_broadcast_and_by_shuffle(spark, monkeypatch, limit):
    monkeypatch.setattr(common, "KEY_ROWS", limit)
    docs = cases.clashing(cases.documents(spark))
    gone = docs.filter("doc_id IS NULL OR doc_id IN (3, 1005, 1006)")
    keys = common.document_keys(gone)
    left = common.without(docs, keys)
    assert left.columns == docs.columns
    assert cases.rows_of(left) == cases.rows_of(docs.filter("doc_id NOT IN (3, 1005, 1006)"))
    assert cases.rows_of(common.without(docs, keys.limit(0))) == cases.rows_of(docs)


def test_operators_beyond_the_broadcast_limits(spark, monkeypatch):
    docs = cases.documents(spark)
    pages = spark.createDataFrame([(i, f"http://a.b/{i % 5}", f"{i % 7}") for i in range(60)], "page_id long, url string, html string")
    few = [
        cases.rows_of(substring.without_repeats(docs).drop("first_ids")),
        cases.rows_of(simhash.deduplicated(docs)),
        cases.rows_of(warc.archived(pages)),
    ]
    for module in (common, quality, warc):
        monkeypatch.setattr(module, "KEY_ROWS", 0)
    monkeypatch.setattr(substring, "small_table", lambda df: None)
    many = [
        cases.rows_of(substring.without_repeats(docs).drop("first_ids")),
        cases.rows_of(simhash.deduplicated(docs)),
        cases.rows_of(warc.archived(pages)),
    ]
    assert many == few


def test_runtime_filters_restore_the_session(spark):
    before = {k: spark.conf.get(k) for k in common.FILTERS}
    with pytest.raises(ZeroDivisionError), common.runtime_filters(spark):
        assert spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold") == "0"
        1 / 0  # noqa: B018
    assert {k: spark.conf.get(k) for k in common.FILTERS} == before
