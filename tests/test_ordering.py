import os

from pyspark.sql import functions as F

from headway.operators import ordering
from headway.session import intermediates, materialise


def test_numbers_follow_the_order(spark):
    df = spark.range(1000).select(F.concat(F.lit("k"), F.lpad(F.col("id") % 300, 3, "0")).alias("k"), "id")
    table, rows = ordering.numbered(df, [F.col("k"), F.col("id").desc()], "test")
    got = [(r["k"], r["id"]) for r in table.orderBy("_number").collect()]
    assert rows == 1000 and sorted(r["_number"] for r in table.collect()) == list(range(1000))
    assert got == sorted(got, key=lambda r: (r[0], -r[1]))


def test_one_key_is_spread_over_the_parts(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20_000).select(F.lit(1).alias("k"))
        parts = ordering.in_order(df, [F.col("k")], "test").groupBy("_part").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) == 4 and max(r["count"] for r in parts) < 8000
    empty, rows = ordering.numbered(df.limit(0), [F.col("k")], "test")
    assert rows == 0 and empty.count() == 0


def test_intermediates_go_at_the_end_of_their_block(spark):
    with intermediates(spark):
        gone, kept = materialise(spark.range(5), "gone"), materialise(spark.range(5), "kept", keep=True)
        paths = [df.inputFiles()[0].removeprefix("file:") for df in (gone, kept)]
        paths = ["/" + p.lstrip("/") for p in paths]
        assert all(map(os.path.exists, paths))
    assert [os.path.exists(p) for p in paths] == [False, True]
