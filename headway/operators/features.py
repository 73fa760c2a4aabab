"""Feature tables: calendar, weather, labels, route-hour statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway import schema as S
from headway.functions import calendar, labels, numeric, text, time
from headway.operators.cleaning import complete_rows, finite_columns, valid_delays
from headway.operators.ranking import counted_quantiles, exact_quantiles, value_counts
from headway.session import lookup_join, materialise


def join_conditions(arrivals: DataFrame, conditions: DataFrame, drop_incomplete: bool = False) -> DataFrame:
    """Each arrival with the weather of the hour it happened in.

    An arrival without weather keeps nulls; an hour listed twice repeats its arrivals.
    """
    hourly = conditions.withColumnRenamed("timestamp_hour", "event_hour")
    timed = arrivals.withColumn("event_hour", time.floor_hour(F.col("actual_dt")))
    joined = lookup_join(timed, hourly, ["event_hour"], "left")
    weather = [c for c in hourly.columns if c != "event_hour"]
    joined = joined.select(*arrivals.columns, "event_hour", *weather)
    return complete_rows(joined) if drop_incomplete else joined


def add_calendar(df: DataFrame) -> DataFrame:
    day = F.col("service_date")
    return df.withColumn("service_date", day.cast("date")).withColumns(
        {
            "month": F.month(day),
            "day_of_year": F.dayofyear(day),
            "season": calendar.season(day),
            "is_holiday": calendar.holiday_flag(day),
            "is_school_in_session": calendar.school_flag(day),
        }
    )


def year_range(df: DataFrame, column: str = "service_date") -> DataFrame:
    return df.agg(F.min(F.year(column)).alias("first_year"), F.max(F.year(column)).alias("last_year"))


def numeric_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns as finite numbers: text is parsed, floating-point values are checked."""
    changed = {}
    for field in df.schema:
        if field.name in columns and not isinstance(field.dataType, T.IntegralType):
            changed[field.name] = numeric.to_number(F.col(field.name))
    return df.withColumns(changed)


def processed_table(
    df: DataFrame, tolerance: float = S.TOLERANCE_SECONDS, clipped_delay: bool = False
) -> DataFrame:
    """Integrated rows to the table all models share: validity filter, features, labels."""
    out = valid_delays(numeric_columns(df, ["delay_seconds", *S.PROCESSED_NUMERIC]))
    out = add_calendar(out)
    out = out.withColumn("rainy_rush_hour", numeric.rainy_rush_hour(F.col("precip_mm"), F.col("hour")))
    if clipped_delay:
        limit = S.VALID_DELAY_SECONDS
        out = out.withColumn("delay_sec_clipped", numeric.clip(F.col("delay_seconds"), -limit, limit))
    out = out.withColumns({c: F.col(c).cast("float") for c in S.PROCESSED_NUMERIC})
    return out.withColumn(
        "label_mc", labels.three_way_label(F.col("delay_seconds"), tolerance)
    ).withColumns(
        {
            "label": labels.delayed_class(F.col("label_mc")),
            "delay_minutes": F.col("delay_seconds") / 60.0,
        }
    )


def linear_features(df: DataFrame, threshold: float) -> DataFrame:
    """Features and ``is_delayed`` of the command-line linear models."""
    out = complete_rows(
        finite_columns(df).withColumn("service_date", F.col("service_date").cast("date")),
        ["service_date", "delay_minutes"],
    )
    sine, cosine = numeric.wind_parts(F.col("wind_dir_deg"))
    out = out.withColumns(
        {c: text.category(F.col(c)) for c in S.LINEAR_CATEGORICAL}
        | {
            "is_delayed": labels.late_by(F.col("delay_minutes"), threshold),
            "wind_dir_sin": sine,
            "wind_dir_cos": cosine,
        }
    )
    return out.withColumn("route_id", text.pad_two(F.col("route_id")))


def notebook_features(df: DataFrame, threshold: float = 5.0) -> DataFrame:
    """Features of the notebook models: missing wind counts as north, season of a null date is -1."""
    out = add_calendar(df).withColumn("season", F.coalesce(F.col("season"), F.lit(-1)).cast("string"))
    out = numeric_columns(out, S.NOTEBOOK_PARSED)
    out = complete_rows(out, ["service_date", "delay_minutes"])
    sine, cosine = numeric.wind_parts(F.col("wind_dir_deg"), fill_missing=True)
    ids = ["route_id", "direction_id", "stop_id", "point_type", "weather_condition"]
    out = out.withColumns(
        {c: F.coalesce(F.col(c).cast("string"), F.lit(S.MISSING)) for c in ids}
        | {
            "is_delayed": labels.late_by(F.col("delay_minutes"), threshold),
            "wind_dir_sin": sine,
            "wind_dir_cos": cosine,
            "rainy_rush_hour": numeric.rainy_rush_hour(F.col("precip_mm"), F.col("hour")),
        }
    )
    return out.withColumn("route_id", text.pad_two(F.col("route_id")))


def legacy_features(df: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Features of the first logistic model."""
    out = complete_rows(
        finite_columns(df).withColumn("service_date", F.col("service_date").cast("date")),
        ["service_date", "delay_minutes"],
    )
    sine, cosine = numeric.wind_parts(F.col("wind_dir_deg"))
    out = out.withColumns(
        {
            "is_delayed": labels.late_by(F.col("delay_minutes"), threshold),
            "route_id": text.pad_two(F.col("route_id").cast("string")),
            "direction_id": F.coalesce(F.col("direction_id").cast("string"), F.lit(S.MISSING)),
            "point_type": F.coalesce(F.col("point_type").cast("string"), F.lit(S.MISSING)),
            "weather_condition": text.legacy_category(F.col("weather_condition")),
            "wind_dir_sin": sine,
            "wind_dir_cos": cosine,
        }
    )
    return out


def route_hour_stats(train: DataFrame, keys: Sequence[str] = S.ROUTE_HOUR_KEYS) -> DataFrame:
    """Mean, exact median and count of the delay per route, hour and weekday."""
    keys = list(keys)
    known = train.dropna(subset=keys)
    # keys whose delays are all missing have no value to count, but a row with count 0
    without = known.where(F.col("delay_minutes").isNull()).select(*keys).distinct()
    counted = value_counts(known, "delay_minutes", keys)
    means = counted.groupBy(*keys).agg(
        (F.sum(F.col("delay_minutes") * F.col("_n")) / F.sum("_n")).alias("route_hour_delay_mean"),
        F.sum("_n").cast("double").alias("route_hour_delay_count"),
    )
    medians = counted_quantiles(counted, "delay_minutes", {"route_hour_delay_median": 0.5}, keys)
    return (
        without.join(means, keys, "full")
        .join(medians, keys, "left")
        .na.fill({"route_hour_delay_count": 0.0})
        .select(*keys, *S.ROUTE_HOUR_STATS)
    )


def attach_route_hour_stats(
    train: DataFrame, *others: DataFrame, keys: Sequence[str] = S.ROUTE_HOUR_KEYS
) -> list[DataFrame]:
    """Join train statistics to train and the other splits; gaps get the train medians.

    The fill is the median over the joined train rows. Every row of a key carries
    the same statistic, so it is computed as a median of the statistics weighted
    by rows per key, without sorting the joined rows.
    """
    keys = list(keys)
    stats = materialise(route_hour_stats(train, keys), "route-hour")
    rows = train.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    long = (
        stats.join(rows, keys)
        .select("_rows", F.expr(_stack(S.ROUTE_HOUR_STATS)))
        .where(F.col("value").isNotNull())
    )
    medians = exact_quantiles(long, "value", {"median": 0.5}, ["stat"], weight="_rows").collect()
    fills = {row["stat"]: row["median"] for row in medians}  # three numbers
    return [lookup_join(df, stats, keys).na.fill(fills) for df in (train, *others)]


def _stack(columns: Sequence[str]) -> str:
    parts = ", ".join(f"'{c}', cast({c} as double)" for c in columns)
    return f"stack({len(columns)}, {parts}) as (stat, value)"
