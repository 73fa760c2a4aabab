"""Order statistics that never put a whole group, or the whole table, into one task.

All of them start from a table that is already counted per distinct value, so
copies of a value are combined on the map side before anything is shuffled. The
counted values are range-sorted over the tasks; sums inside the parts plus the
totals of the parts below give exact running totals. This is one path for every
size and for every type Spark can order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.operators.ordering import in_order
from headway.session import lookup_join, materialise

# Distinct values of all groups that the built-in quantile may count in memory.
FEW_VALUES = 1_000_000


def running_totals(
    counted: DataFrame,
    value: str,
    measures: Sequence[str],
    groups: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add ``<m>_upto`` and ``<m>_total`` for each measure.

    ``counted`` has one row per (groups, value) and no null in either. ``_upto`` is
    the sum over the rows of the group up to and including this one in the order
    of ``value`` (NaN is the largest number); ``_total`` is the sum over the group.
    """
    groups = list(groups)
    order = F.col(value).desc() if descending else F.col(value)
    parts = in_order(counted, [*map(F.col, groups), order], "ordered")

    # One row per group and part: the windows below see as many rows per group as there are parts.
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    offsets = (
        parts.groupBy(*groups, "_part")
        .agg(*[F.sum(m).alias(f"_{m}") for m in measures])
        .select(
            *groups,
            "_part",
            *[F.coalesce(F.sum(f"_{m}").over(before), F.lit(0)).alias(f"_{m}_before") for m in measures],
            *[F.sum(f"_{m}").over(whole).alias(f"{m}_total") for m in measures],
        )
    )
    within = (
        Window.partitionBy(*groups, "_part")
        .orderBy("_pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = lookup_join(parts, offsets, [*groups, "_part"], "inner")
    return joined.withColumns(
        {f"{m}_upto": F.col(f"_{m}_before") + F.sum(m).over(within) for m in measures}
    ).drop("_part", "_pos", *[f"_{m}_before" for m in measures])


def exact_quantiles(
    df: DataFrame,
    value: str,
    shares: dict[str, float],
    groups: Sequence[str] = (),
    weight: str | None = None,
    few_values: int = FEW_VALUES,
) -> DataFrame:
    """Exact quantiles of numbers by linear interpolation, one row per group.

    ``shares`` maps output column to quantile, e.g. ``{"median": 0.5}``. An integer
    ``weight`` column counts each row that many times. Rows with a null or NaN value,
    or a null group as in any grouping here, are left out.
    """
    counted = value_counts(df, value, groups, weight)
    return counted_quantiles(counted, value, shares, groups, few_values)


def value_counts(
    df: DataFrame, value: str, groups: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Rows (``_n``) per group and value, written once; nulls and NaN are left out."""
    known = df.dropna(subset=[value, *groups])
    if isinstance(df.schema[value].dataType, T.FractionalType):
        known = known.where(~F.isnan(value))
    counted = known.groupBy(*groups, value).agg(
        (F.sum(weight) if weight else F.count(F.lit(1))).cast("long").alias("_n")
    )
    return materialise(counted, "counted")


def counted_quantiles(
    counted: DataFrame,
    value: str,
    shares: dict[str, float],
    groups: Sequence[str] = (),
    few_values: int = FEW_VALUES,
) -> DataFrame:
    """As ``exact_quantiles`` for a table of ``value_counts``.

    A few distinct values are left to the built-in, which gives the same numbers from
    counts in memory; it never sees more than ``few_values`` of them.
    """
    groups = list(groups)
    if counted.count() <= few_values:
        found = F.percentile(value, list(shares.values()), F.col("_n"))
        return counted.groupBy(*groups).agg(found.alias("_found")).select(
            *groups, *[F.get("_found", F.lit(i)).alias(name) for i, name in enumerate(shares)]
        )

    ranked = running_totals(counted, value, ["_n"], groups)

    picks, results = [], []
    for name, share in shares.items():
        at = F.lit(float(share)) * (F.col("_n_total") - 1)
        picks += [
            F.min(F.when(F.col("_n_upto") > F.floor(at), F.col(value))).alias(f"_lo_{name}"),
            F.min(F.when(F.col("_n_upto") > F.ceil(at), F.col(value))).alias(f"_hi_{name}"),
        ]
        total_at = F.lit(float(share)) * (F.col("_total") - 1)
        low, high = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        results.append((low + (high - low) * (total_at - F.floor(total_at))).alias(name))
    return (
        ranked.groupBy(*groups)
        .agg(F.max("_n_total").alias("_total"), *picks)
        .select(*groups, *results)
    )


def mark_smallest(
    df: DataFrame,
    order: str,
    key: str,
    output: str,
    share: float | None = None,
    rows: int | None = None,
    groups: Sequence[str] = (),
) -> DataFrame:
    """Flag, per group, exactly the ``rows`` (or ``share``) smallest rows by (order, key).

    The cut is found on counts per ``order`` value and then, inside the one value it
    falls in, on ``key`` (unique). Marking itself is a filter expression over the
    unshuffled rows while the groups are few. Null is a group like any other.
    """
    group = F.to_json(F.struct(*[F.col(g) for g in groups])) if groups else F.lit("")
    source = df.withColumn("_group", group)
    counted = source.groupBy("_group", order).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_totals(materialise(counted, "counted"), order, ["_n"], ["_group"])
    if rows is not None:
        wanted = F.lit(int(rows)).cast("long")
    else:
        wanted = F.round(F.col("_n_total") * F.lit(float(share))).cast("long")
    cuts = (
        ranked.withColumn("_wanted", wanted)
        .groupBy("_group")
        .agg(
            F.min(F.when(F.col("_n_upto") > F.col("_wanted"), F.col(order))).alias("_edge"),
            F.max(F.when(F.col("_n_upto") <= F.col("_wanted"), F.col("_n_upto"))).alias("_taken"),
            F.max("_wanted").alias("_wanted"),
            (F.max("_n_total") <= F.max("_wanted")).alias("_whole"),
        )
        .select("_group", "_edge", "_whole", (F.col("_wanted") - F.coalesce("_taken", F.lit(0))).alias("_rest"))
    )
    marked = lookup_join(source, materialise(cuts, "cuts"), ["_group"])

    # Rows of the one order value the cut falls in, ranked by key.
    edge_rows = (
        marked.where((F.col(order) == F.col("_edge")) & (F.col("_rest") > 0))
        .groupBy("_group", key, "_rest")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    edge = running_totals(materialise(edge_rows, "counted"), key, ["_n"], ["_group"])
    edge_keys = edge.where(F.col("_n_upto") <= F.col("_rest")).groupBy("_group").agg(F.max(key).alias("_key"))
    marked = lookup_join(marked, materialise(edge_keys, "cuts"), ["_group"])
    inside = (
        F.col("_whole")
        | (F.col(order) < F.col("_edge"))
        | ((F.col(order) == F.col("_edge")) & (F.col(key) <= F.col("_key")))
    )
    return marked.withColumn(output, F.coalesce(inside, F.lit(False))).drop(
        "_group", "_edge", "_whole", "_rest", "_key"
    )


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` most frequent non-null values with their counts; ties in value order."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column)
        .limit(n)
    )
