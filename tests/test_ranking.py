import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway import session
from headway.operators import ranking, splits
from headway.session import lookup_join, salted_join


def skewed(spark, rows=3000):
    """A third of all rows share one group, and a third of those one value."""
    rng = random.Random(7)
    data = []
    for i in range(rows):
        group = "hot" if i % 3 == 0 else f"g{rng.randrange(40)}"
        value = 5.0 if group == "hot" and i % 9 == 0 else round(rng.gauss(0, 3), 2)
        data.append((i, group, value))
    return data, spark.createDataFrame(data, "id long, g string, x double")


@pytest.fixture
def many_parts(spark):
    """Small tables stay in as many parts as there are shuffle partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("few_values", [10_000, 100])
def test_exact_quantiles_match_numpy(spark, many_parts, few_values):
    data, df = skewed(spark)
    shares = {"q": 0.25, "m": 0.5, "t": 0.9}
    got = {r["g"]: r for r in ranking.exact_quantiles(df, "x", shares, ["g"], few_values=few_values).collect()}
    groups = {}
    for _, g, x in data:
        groups.setdefault(g, []).append(x)
    assert set(got) == set(groups)
    for g, xs in groups.items():
        for name, share in shares.items():
            assert got[g][name] == pytest.approx(np.quantile(xs, share), abs=1e-9)


@pytest.mark.parametrize("few_values", [10_000, 2])
def test_weighted_median(spark, many_parts, few_values):
    df = spark.createDataFrame([(1.0, 1), (2.0, 4), (9.0, 1), (None, 50), (float("nan"), 50)], "x double, w long")
    assert ranking.exact_quantiles(df, "x", {"m": 0.5}, weight="w", few_values=few_values).first()["m"] == 2.0


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("kind", ["double", "string", "date", "timestamp_ntz"])
def test_running_totals_in_parts(spark, many_parts, descending, kind):
    names = [(f"stop-id-{i:05d}", i % 7) for i in range(500)]
    df = spark.createDataFrame(names, "v string, n long")
    number = F.substring("v", -5, 5).cast("int")
    if kind == "double":
        df = df.withColumn("v", F.when(number == 499, F.lit(float("nan"))).otherwise(number.cast("double")))
    elif kind != "string":
        df = df.withColumn("v", F.date_add(F.lit("2024-01-01").cast("date"), number).cast(kind))
    got = ranking.running_totals(df, "v", ["n"], descending=descending)
    largest = lambda v: float("inf") if isinstance(v, float) and v != v else v
    rows = sorted(got.collect(), key=lambda r: largest(r["v"]), reverse=descending)
    assert len(rows) == 500
    total = 0
    for r in rows:
        total += r["n"]
        assert r["n_upto"] == total
    assert {r["n_total"] for r in rows} == {total}


def test_mark_smallest_is_exact_with_ties(spark):
    df = spark.range(1000).withColumn("h", F.col("id") % 7).withColumn("c", F.col("id") % 2)
    got = ranking.mark_smallest(df, "h", "id", "in", rows=333)
    expected = {i for _, i in sorted((i % 7, i) for i in range(1000))[:333]}
    assert {r["id"] for r in got.where("in").collect()} == expected
    assert got.count() == 1000
    by_class = ranking.mark_smallest(df, "h", "id", "in", share=0.2, groups=["c"]).where("in")
    assert {r["c"]: r["count"] for r in by_class.groupBy("c").count().collect()} == {0: 100, 1: 100}
    assert ranking.mark_smallest(df, "h", "id", "in", rows=5000).where("in").count() == 1000
    missing = df.withColumn("c", F.when(F.col("c") == 1, 1))
    by_class = ranking.mark_smallest(missing, "h", "id", "in", share=0.2, groups=["c"]).where("in")
    assert {r["c"]: r["count"] for r in by_class.groupBy("c").count().collect()} == {None: 100, 1: 100}


def test_salted_join_keeps_all_rows(spark):
    facts = spark.range(5000).withColumn("k", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50))
    table = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    want = sorted((r["id"], r["v"]) for r in facts.join(table, "k", "left").collect())
    got = salted_join(facts, table, ["k"])
    assert sorted((r["id"], r["v"]) for r in got.collect()) == want
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().optimizedPlan().toString()
    beyond = lookup_join(facts, table, ["k"], max_rows=10)
    assert sorted((r["id"], r["v"]) for r in beyond.collect()) == want


def test_salted_join_shuffles_and_copies_frequent_keys_only(spark, monkeypatch):
    monkeypatch.setattr(session, "HOT_ROWS", 1000)
    facts = spark.range(5000).withColumn("k", F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id") % 50))
    table = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    want = sorted(((r["id"], r["v"]) for r in facts.join(table, "k", "left").collect()), key=str)
    got = salted_join(facts, table, ["k"])
    assert sorted(((r["id"], r["v"]) for r in got.collect()), key=str) == want
    # the copies are as many times the table, so they must not be broadcast by the table's size
    assert "SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()
    inner = salted_join(facts, table, ["k"], "inner")
    assert inner.count() == sum(v is not None for _, v in want)


def test_splits_and_samples(spark):
    df = spark.createDataFrame(
        [("2022-12-31", 0), ("2023-01-01", 1), ("2023-09-30", 0), ("2023-10-01", 1), ("2023-12-31", 0),
         ("2024-01-01", 1), ("2024-12-31", 0), ("2025-01-01", 1), (None, 1)],
        "d string, y int",
    ).select(F.col("d").cast("date").alias("service_date"), "y")
    got = splits.dated_splits(df)
    counts = {r["split"]: r["n_rows"] for r in splits.split_sizes(got, "y").collect()}
    assert counts == {"train": 2, "val": 2, "test": 2}
    splits.check_splits(got, "y")
    with pytest.raises(ValueError, match="empty split: test"):
        splits.check_splits(got.where("split <> 'test'"), "y")
    with pytest.raises(ValueError, match="single class"):
        splits.check_splits(got.withColumn("y", F.lit(1)), "y")
    with pytest.raises(ValueError, match="fraction"):
        splits.fraction_sample(df, "y", 1.5)
    before, after = splits.split_at(df, "2024-01-01")
    assert (before.count(), after.count()) == (5, 3)
    ids = spark.range(20_000)
    assert splits.fixed_sample(ids, "id", 123).count() == 123
    assert splits.row_cap(ids, 50, "id").agg(F.max("id")).first()[0] == 49
    assert splits.row_cap(ids, -1, "id").count() == 20_000
    for key in ("id", "t", ["t", "id"]):
        named = ids.withColumn("t", F.concat(F.lit("x"), "id"))
        assert 0.28 < splits.fraction_sample(named, key, 0.3).count() / 20_000 < 0.32
        assert splits.fixed_sample(named, key, 123).count() == 123
    assert splits.row_cap(ids.select(F.lpad("id", 6, "0").alias("t")), 50, "t").count() == 50


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    assert [r["v"] for r in ranking.top_values(df, "v", 2).collect()] == ["c", "a"]
