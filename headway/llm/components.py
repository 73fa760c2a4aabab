"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.session import materialise

MAX_ROUNDS = 60


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node beside it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (long columns a, b); root is the smallest node reachable.

    The links stay in written tables from round to round; the driver sees a count and a
    checksum. Loops and repeated links are ignored; no links give no rows.
    """
    table = materialise(edges.filter("a <> b").select("a", "b").distinct(), "links")
    before = _signature(table)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        star = _small_star(_large_star(table).filter("a <> b").distinct()).distinct()
        table = materialise(star, "links")
        after = _signature(table)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components have not settled")
    roots = table.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return table.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
