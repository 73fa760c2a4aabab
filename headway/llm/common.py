"""What several corpus operators need: row keys, joins that stand hot keys, row numbers.

A document is identified by ``doc_id`` and a hash of its text, compared null-safe, so
that null and repeated ids do no harm. Rows equal in both are copies of one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import ship_code, small_table

# A key with more than this share of all rows is hot; there are fewer than 1 / share of them.
HOT_SHARE = 0.001

# Row keys up to this number may be broadcast (16 bytes each); beyond it both sides are shuffled.
KEY_ROWS = 1_000_000

# Texts reach Python in batches of so many rows: a few megabytes each.
BATCH_ROWS = 1000

FILTERS = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1TB",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "50000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(1 << 29),
}


@contextmanager
def runtime_filters(spark: SparkSession) -> Iterator[None]:
    """Joins run inside drop rows without a partner by a Bloom filter before their shuffle.

    The filter has 64 MB at most; the join behind it is exact whatever the filter lets pass.
    """
    before = {k: spark.conf.get(k) for k in FILTERS}
    for k, v in FILTERS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def text_hash(column: str = "text") -> Column:
    return F.xxhash64(F.col(column))


def small_batches(docs: DataFrame) -> None:
    """Let Python workers find this package and see ``BATCH_ROWS`` texts at a time in this session."""
    ship_code(docs.sparkSession)
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def document_keys(docs: DataFrame, *more: Column) -> DataFrame:
    """``doc_id`` as long, ``h``, and further columns computed from the documents."""
    small_batches(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("h"), *more)


def packed(docs: DataFrame) -> DataFrame:
    """The documents as one struct column beside their key, so that no column name can clash."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(
        whole, F.col("doc_id").cast("long").alias("_id"), text_hash().alias("_h")
    )


def same_document(left: DataFrame, right: DataFrame) -> Column:
    return left["_id"].eqNullSafe(right["doc_id"]) & (left["_h"] == right["h"])


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The documents whose key is not in ``dropped`` (columns doc_id, h).

    Few keys are broadcast after their number is known; more are joined by a shuffle.
    """
    rows = packed(docs)
    keys = dropped.select("doc_id", "h").distinct()
    local = small_table(keys, KEY_ROWS)
    other = keys if local is None else F.broadcast(local)
    return rows.join(other, same_document(rows, other), "left_anti").select("row.*")


def one_of_each(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """One row of each key in ``repeated`` (doc_id, h), all other rows unchanged."""
    rows = packed(docs)
    keys = repeated.select("doc_id", "h").distinct()
    local = small_table(keys, KEY_ROWS)
    other = keys if local is None else F.broadcast(local)
    single = rows.join(other, same_document(rows, other), "left_anti")
    copies = rows.join(other, same_document(rows, other), "left_semi")
    first = copies.groupBy("_id", "_h").agg(F.first("row").alias("row"))
    return single.select("row.*").unionByName(first.select("row.*"))


def spread_join(facts: DataFrame, table: DataFrame, key: str, rows: str) -> DataFrame:
    """Inner join of ``facts`` to ``table``, which has one row per key and its number of facts.

    The few hot keys (fewer than 1 / HOT_SHARE by their definition) are broadcast, the
    others meet by a shuffle in which no key has more than HOT_SHARE of the rows.
    """
    total = table.agg(F.sum(rows)).first()[0] or 0
    limit = total * HOT_SHARE
    hot = F.broadcast(table.filter(F.col(rows) > limit))
    cold = table.filter(F.col(rows) <= limit)
    return facts.join(hot, key).unionByName(
        facts.join(hot.select(key), key, "left_anti").join(cold, key)
    )
