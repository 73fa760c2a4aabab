"""Cleaning of raw arrivals and weather, and the row filters."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway import schema as S
from headway.functions import numeric, time

FLOATING = (T.DoubleType, T.FloatType)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Exact duplicates removed over all columns; nulls are equal to each other.

    Copies are dropped on the map side first and the shuffle key is the whole row,
    so a group of copies reaches the reducer as at most one row per map task.
    """
    return df.distinct()


def add_time_features(raw: DataFrame) -> DataFrame:
    """Timestamps on the service date, delay, hour, weekday and weekend flag.

    Only the time of day of ``scheduled`` and ``actual`` is used: an arrival after
    midnight of a trip scheduled before it therefore gets a large negative delay,
    which the validity filter later removes.
    """
    scheduled = time.at_time_of(F.col("service_date"), time.parse_timestamp(F.col("scheduled")))
    actual = time.at_time_of(F.col("service_date"), time.parse_timestamp(F.col("actual")))
    return (
        raw.withColumn("service_date", F.col("service_date").try_cast("date"))
        .withColumns({"scheduled_dt": scheduled, "actual_dt": actual})
        .withColumn("delay_seconds", time.seconds_between(F.col("scheduled_dt"), F.col("actual_dt")))
        .withColumns(
            {
                "delay_minutes": F.col("delay_seconds") / 60.0,
                "hour": F.hour("scheduled_dt"),
                "weekday": time.monday_first(F.col("scheduled_dt")),
            }
        )
        .withColumn("is_weekend", time.weekend_flag(F.col("weekday")))
    )


def clean_arrivals(raw: DataFrame) -> DataFrame:
    """Raw arrivals to the clean 13-column table."""
    return add_time_features(distinct_rows(raw)).select(*S.CLEAN_ARRIVAL_COLUMNS)


def condition_label(code):
    """Weather code to label; an unknown code gives null."""
    pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in S.CONDITION_LABELS.items())
    return F.create_map(*pairs)[code]


def clean_conditions(raw: DataFrame) -> DataFrame:
    """Hourly weather with a timestamp, clear column names and text labels."""
    unwanted = [c for c in raw.columns if c.endswith("_source")]
    hour = time.hour_timestamp(*[F.col(c) for c in ("year", "month", "day", "hour")])
    return (
        raw.drop(*unwanted, "wpgt")
        .select(hour.alias("timestamp_hour"), *S.CONDITION_COLUMNS)
        .withColumnsRenamed(S.CONDITION_COLUMNS)
        .withColumn("weather_condition", condition_label(F.col("weather_condition").cast("int")))
    )


def finite_columns(df: DataFrame) -> DataFrame:
    """NaN and infinities become null in every floating-point column."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, FLOATING)]
    return df.withColumns({c: numeric.finite(F.col(c)) for c in floating})


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a null in ``columns`` (default: in any column)."""
    return df.dropna(how="any", subset=list(columns) if columns else None)


def is_valid_delay(limit: float = S.VALID_DELAY_SECONDS):
    return F.coalesce(F.col("delay_seconds").between(-limit, limit), F.lit(False))


def valid_delays(df: DataFrame, limit: float = S.VALID_DELAY_SECONDS) -> DataFrame:
    """Rows with a delay within +-limit, both ends included."""
    return df.where(F.col("delay_seconds").between(-limit, limit))


def rejected_delays(df: DataFrame, limit: float = S.VALID_DELAY_SECONDS) -> DataFrame:
    """How many rows ``valid_delays`` keeps and rejects."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_total"),
        F.count_if(is_valid_delay(limit)).alias("rows_valid"),
        F.count_if(~is_valid_delay(limit)).alias("rows_rejected"),
    )
