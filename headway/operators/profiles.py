"""The tables behind the exploration reports."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway import schema as S
from headway.functions import numeric
from headway.operators.ranking import counted_quantiles, exact_quantiles, value_counts
from headway.session import lookup_join, materialise


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per (kept columns, column, value), values as doubles, nulls left out."""
    parts = ", ".join(f"'{c}', cast(`{c}` as double)" for c in columns)
    return df.select(*keep, F.expr(f"stack({len(columns)}, {parts}) as (column, value)")).where(
        F.col("value").isNotNull()
    )


def service_heatmap(df: DataFrame, days: int = S.HEATMAP_DAYS) -> DataFrame:
    """Mean delay per service date (rows) and hour (columns), latest ``days`` dates, ascending."""
    hours = list(range(24))
    table = (
        df.dropna(subset=["service_date", "hour", "delay_minutes"])
        .withColumn("hour", F.col("hour").cast("int"))
        .groupBy("service_date")
        .pivot("hour", hours)
        .agg(F.avg("delay_minutes"))
        .withColumnsRenamed({str(h): f"hour_{h}" for h in hours})
    )
    return table.orderBy(F.desc("service_date")).limit(days).orderBy("service_date")


def hourly_profile(df: DataFrame, label: str = "is_delayed", **means: str) -> DataFrame:
    """Delay per hour; ``means`` adds averages of further columns under new names."""
    return (
        df.where(F.col("hour").isNotNull())
        .groupBy("hour")
        .agg(
            F.avg("delay_minutes").alias("mean_delay"),
            F.count("delay_minutes").alias("n_trips"),
            F.avg(label).alias("delay_rate"),
            *[F.avg(column).alias(name) for name, column in means.items()],
        )
    )


def hourly_median(df: DataFrame, min_trips: int = 500) -> DataFrame:
    """Exact median delay of the hours with enough trips."""
    counted = value_counts(df, "delay_minutes", ["hour"])
    trips = counted.groupBy("hour").agg(F.sum("_n").alias("trip_count"))
    medians = counted_quantiles(counted, "delay_minutes", {"median_delay": 0.5}, ["hour"])
    return trips.where(F.col("trip_count") >= min_trips).join(medians, "hour")


def weekday_profile(df: DataFrame) -> DataFrame:
    known = df.where(F.col("weekday").isNotNull() & F.col("delay_minutes").isNotNull())
    names = F.array(*[F.lit(name) for name in S.WEEKDAY_LABELS])
    return (
        known.groupBy(F.col("weekday").cast("int").alias("weekday"))
        .agg(F.avg("delay_minutes").alias("mean_delay"))
        .withColumn("weekday_label", F.get(names, F.col("weekday") % 7))
    )


def condition_ranking(df: DataFrame, n: int = 10) -> DataFrame:
    """Weather labels with the highest mean delay."""
    return (
        df.where(F.col("weather_condition").isNotNull() & F.col("delay_minutes").isNotNull())
        .groupBy("weather_condition")
        .agg(F.avg("delay_minutes").alias("mean_delay"))
        .orderBy(F.desc("mean_delay"), "weather_condition")
        .limit(n)
    )


def route_rates(df: DataFrame, label: str = "is_delayed") -> DataFrame:
    return (
        df.where(F.col("route_id").isNotNull())
        .groupBy("route_id")
        .agg(F.avg(label).alias("delay_rate"), F.count(F.lit(1)).alias("n_trips"))
    )


def route_ranking(df: DataFrame, n: int = 15, label: str = "is_delayed") -> DataFrame:
    """Routes with the highest share of delayed trips; ties in route order."""
    return route_rates(df, label).orderBy(F.desc("delay_rate"), "route_id").limit(n)


def rain_profile(df: DataFrame, label: str = "is_delayed") -> DataFrame:
    """Delay rate and mean delay per millimetre of rain, everything above ten in the last bin."""
    clipped = numeric.clip(F.col("precip_mm"), 0.0, 10.0)
    edges = [float(e) for e in range(11)]
    return (
        df.withColumn("rain_bin", numeric.right_closed_bin(clipped, edges))
        .where(F.col("rain_bin").isNotNull())
        .groupBy("rain_bin")
        .agg(
            F.avg(label).alias("delay_rate"),
            F.avg("delay_minutes").alias("mean_delay"),
            F.count(F.lit(1)).alias("n_trips"),
        )
    )


def category_frequencies(df: DataFrame, limits: dict[str, int | None]) -> DataFrame:
    """Counts of the values of several columns in one pass; the top n, or all where n is None."""
    parts = ", ".join(f"'{c}', cast(`{c}` as string)" for c in limits)
    counts = (
        df.select(F.expr(f"stack({len(limits)}, {parts}) as (column, value)"))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts = materialise(counts, "frequencies")
    whole = [c for c, n in limits.items() if not n]
    limit = F.create_map(*[F.lit(x) for c, n in limits.items() if n for x in (c, n)])
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value"))
    most = max((n for n in limits.values() if n), default=0)
    # rank <= literal lets Spark drop all but that many rows per column before the shuffle
    top = (
        counts.where(~F.col("column").isin(whole))
        .withColumn("_rank", rank)
        .where((F.col("_rank") <= most) & (F.col("_rank") <= F.element_at(limit, F.col("column"))))
        .drop("_rank")
    )
    return counts.where(F.col("column").isin(whole)).unionByName(top)


def label_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_shares(df: DataFrame, label: str, by: str = "split") -> DataFrame:
    """Share of each class inside each split."""
    counts = df.groupBy(by, label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(by))
    return counts.withColumn("share", F.col("n") / total)


def positive_rate(df: DataFrame, label: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(label).alias("n_positive"),
        F.avg(label).alias("positive_rate"),
    )


def column_overview(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Type, non-null count and distinct count of each column, by name.

    Exact distinct counts go through (column, digest of the value), deduplicated before
    the shuffle: two narrow columns instead of a copy of the row per column.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    names = sorted(df.columns)
    row = df.agg(
        *[F.count(F.col(c)).alias(f"{c}__n") for c in names],
        *[F.approx_count_distinct(F.col(c)).alias(f"{c}__d") for c in names if approximate],
    )
    if approximate:
        parts = ", ".join(f"'{c}', '{types[c]}', `{c}__n`, `{c}__d`" for c in names)
        return row.select(F.expr(f"stack({len(names)}, {parts}) as (column, dtype, non_null, n_unique)"))
    parts = ", ".join(f"'{c}', '{types[c]}', `{c}__n`" for c in names)
    counts = row.select(F.expr(f"stack({len(names)}, {parts}) as (column, dtype, non_null)"))
    digests = [
        F.struct(F.lit(c).alias("column"), F.unhex(F.md5(F.col(c).cast("string").cast("binary"))).alias("value"))
        for c in names
    ]
    distinct = (
        df.select(F.inline(F.array(*digests)))
        .where(F.col("value").isNotNull())
        .distinct()
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("n_unique"))
    )
    return counts.join(distinct, "column", "left").select(
        "column", "dtype", "non_null", F.coalesce("n_unique", F.lit(0)).alias("n_unique")
    )


def missing_counts(df: DataFrame) -> DataFrame:
    """Columns with nulls and how many, most first."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    parts = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return (
        row.select(F.expr(f"stack({len(df.columns)}, {parts}) as (column, n_missing)"))
        .where(F.col("n_missing") > 0)
        .orderBy(F.desc("n_missing"), "column")
    )


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column."""
    counted = value_counts(long_form(df, columns), "value", ["column"])
    n, mean = F.sum("_n"), F.sum(F.col("value") * F.col("_n")) / F.sum("_n")
    means = counted.groupBy("column").agg(
        n.alias("n"), mean.alias("mean"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    # squares of the distances from the mean, not of the values: no cancellation
    squares = counted.join(F.broadcast(means), "column").groupBy("column").agg(
        F.sum(F.pow(F.col("value") - F.col("mean"), F.lit(2.0)) * F.col("_n")).alias("_squares")
    )
    quartiles = counted_quantiles(counted, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["column"])
    deviation = F.sqrt(F.try_divide(F.col("_squares"), F.col("n") - 1)).alias("std")
    return means.join(squares, "column").join(quartiles, "column").select(
        "column", "n", "mean", deviation, "min", "q25", "q50", "q75", "max"
    )


def box_statistics(
    df: DataFrame,
    columns: Sequence[str] = S.BOX_COLUMNS,
    label: str = "is_delayed",
    whisker: float = 1.5,
) -> DataFrame:
    """Quartiles and whisker ends per column and class; outliers are beyond the whiskers."""
    values = long_form(df, columns, [label])
    keys = [label, "column"]
    quartiles = exact_quantiles(values, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, keys)
    inside = lookup_join(values, quartiles, keys, "inner").where(
        F.col("value").between(
            F.col("q1") - whisker * (F.col("q3") - F.col("q1")),
            F.col("q3") + whisker * (F.col("q3") - F.col("q1")),
        )
    )
    return inside.groupBy(*keys, "q1", "median", "q3").agg(
        F.min("value").alias("whisker_low"), F.max("value").alias("whisker_high")
    )


def value_range(df: DataFrame, value: str) -> tuple[float, float]:
    low, high = df.agg(F.min(value).cast("double"), F.max(value).cast("double")).first()
    if low is None:
        raise ValueError(f"{value} has no values")
    return low, high


def _bins(df: DataFrame, bins: int, *extra) -> DataFrame:
    return df.sparkSession.range(1).select(
        *extra, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Counts of equal-width bins over the range of the data, empty bins included."""
    low, high = value_range(df, value)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(numeric.equal_width_bin(F.col(value), low, high, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        _bins(df, bins)
        .join(F.broadcast(counts), "bin", "left")
        .select(
            "bin",
            (F.lit(low) + F.col("bin") * F.lit((high - low) / bins)).alias("bin_start"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def feature_histograms(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """The non-empty histogram bins of several columns: one pass for the ranges, one for the counts."""
    row = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"{c}__lo") for c in columns],
        *[F.max(F.col(c).cast("double")).alias(f"{c}__hi") for c in columns],
    ).first()
    known = [c for c in columns if row[f"{c}__lo"] is not None]
    binned = df.select(
        *[
            numeric.equal_width_bin(F.col(c), row[f"{c}__lo"], row[f"{c}__hi"], bins).alias(c)
            for c in known
        ]
    )
    parts = ", ".join(f"'{c}', `{c}`" for c in known)
    return (
        binned.select(F.expr(f"stack({len(known)}, {parts}) as (column, bin)"))
        .where(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def class_histogram(df: DataFrame, value: str, label: str, bins: int = 60) -> DataFrame:
    """Percent of each class per bin, bins over the common range."""
    low, high = value_range(df, value)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(label, numeric.equal_width_bin(F.col(value), low, high, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy(label))
    return counts.withColumn("percent", F.col("n") * 100.0 / total)


def delay_density(
    df: DataFrame, value: str, bins: int = 40, points: int = 200, bandwidth: float | None = None
) -> DataFrame:
    """Gaussian kernel density of the binned values on an even grid.

    Each bin (at its centre) adds to each grid point; both are of fixed number. The
    default bandwidth is the sample deviation times n ** -0.2.
    """
    counts = histogram(df, value, bins)
    low, high = value_range(df, value)
    n, deviation = df.agg(F.count(value), F.stddev_samp(value)).first()
    width = bandwidth or (deviation or 0.0) * n ** -0.2
    if width <= 0:
        raise ValueError("no spread in the data; give a bandwidth")
    centre = F.col("bin_start") + F.lit((high - low) / bins / 2)
    grid = F.sequence(F.lit(0), F.lit(points - 1))
    x = F.lit(low) + F.col("point") * F.lit((high - low) / (points - 1))
    kernel = F.exp(-0.5 * F.pow((x - F.col("centre")) / F.lit(width), F.lit(2.0)))
    scale = n * width * math.sqrt(2 * math.pi)
    return (
        counts.where(F.col("n") > 0)
        .select("n", centre.alias("centre"), F.explode(grid).alias("point"))
        .groupBy("point", x.alias("x"))
        .agg((F.sum(F.col("n") * kernel) / F.lit(scale)).alias("density"))
    )


def preview(df: DataFrame, rows: int, *order) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order).limit(rows)


def largest_by_size(df: DataFrame, value: str, name: str, n: int) -> DataFrame:
    """The ``n`` rows with the largest absolute value, signed values kept, in signed order."""
    return (
        df.withColumn("abs_value", F.abs(value))
        .orderBy(F.desc("abs_value"), name)
        .limit(n)
        .orderBy(value, name)
    )

