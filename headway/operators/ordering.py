"""A table in a total order over many tasks, and positions in that order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.session import materialise

POSITION_BITS = 33


def in_order(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """``df`` range-sorted and written once, with its part (``_part``) and place in it (``_pos``).

    Spark samples the values themselves, of any type, for the bounds of the parts. Equal
    keys are split by a row id, so that no key, however frequent, makes a large part.
    """
    row = F.monotonically_increasing_id()
    sorted_parts = (
        df.withColumn("_tie", row)
        .repartitionByRange(*order, F.col("_tie"))
        .sortWithinPartitions(*order, F.col("_tie"))
        # after the sort this id is the part and, in its low bits, the place in the part
        .withColumn("_tie", F.monotonically_increasing_id())
    )
    return materialise(sorted_parts, label).withColumns(
        {
            "_part": F.shiftright("_tie", POSITION_BITS).cast("int"),
            "_pos": F.col("_tie").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)),
        }
    ).drop("_tie")


def numbered(df: DataFrame, order: Sequence[Column], label: str) -> tuple[DataFrame, int]:
    """``df`` with the global row number ``_number`` (from 0) in the given order, and the row count."""
    table = in_order(df, order, label)
    # one size per part, of which there are as many as shuffle partitions
    sizes = sorted((r[0], r[1]) for r in table.groupBy("_part").count().collect())
    before, starts = 0, []
    for part, rows in sizes:
        starts.append((part, before))
        before += rows
    schema = T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("_start", T.LongType())])
    offsets = df.sparkSession.createDataFrame(starts, schema)
    table = table.join(F.broadcast(offsets), "_part")
    return table.withColumn("_number", F.col("_start") + F.col("_pos")).drop("_part", "_pos", "_start"), before
