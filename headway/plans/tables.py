"""The driver's tables under the column names of transit data.

``trips`` and ``raw_arrivals`` come from ``events``, ``hourly_conditions`` from the
activity of the events one day earlier (so the first day has no weather), and
``shipments`` from ``lineitem`` and ``orders`` with seven years of dates. Each
definition is mirrored in ``oracle.TABLES``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions import text, time
from headway.operators.cleaning import clean_conditions, condition_label

# The driver's dates instead of 2023-2024: split points for the seven years of shipments.
SHIPMENT_SPLITS = ("1995-01-01", "1999-01-01", "2000-01-01", "2002-01-01")
TRIP_SPLIT = "2024-01-21"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def event_number():
    """The number in the properties, 0 to 99."""
    return F.get_json_object("props", "$.k").cast("int")


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """Clean arrivals, one per event, plus the unique ``trip_id``."""
    delay = F.col("value") - 50.0
    weekday = time.monday_first(F.col("ts"))
    return events(spark, folder).select(
        F.col("event_id").alias("trip_id"),
        F.col("ts").cast("date").alias("service_date"),
        F.hour("ts").alias("hour"),
        weekday.alias("weekday"),
        time.weekend_flag(weekday).alias("is_weekend"),
        text.pad_two((F.col("user_id") % 30).cast("string")).alias("route_id"),
        (F.col("event_id") % 2).cast("string").alias("direction_id"),
        F.col("user_id").cast("string").alias("stop_id"),
        event_number().alias("time_point_order"),
        F.nullif("event_type", F.lit("error")).alias("point_type"),
        F.col("ts").alias("actual_dt"),
        (delay * 60.0).alias("delay_seconds"),
        delay.alias("delay_minutes"),
    )


def raw_conditions(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly weather in its raw layout."""
    later = F.col("ts") + F.expr("interval 1 day")
    hour = time.floor_hour(later)
    return (
        events(spark, folder)
        .groupBy(hour.alias("at"))
        .agg(
            F.avg("value").alias("temp"),
            F.max("value").alias("rhum"),
            ((F.count(F.lit(1)) % 12) * 0.3).alias("prcp"),
            ((F.min("user_id") * 37) % 360).cast("double").alias("wdir"),
            F.min("value").alias("wspd"),
            (F.count(F.lit(1)) + 1000).cast("double").alias("pres"),
            (F.max("user_id") % 9).cast("double").alias("cldc"),
            (F.min("event_id") % 30 + 1).cast("int").alias("coco"),
            F.max("value").alias("wpgt"),
            F.lit("derived").alias("temp_source"),
        )
        .select(
            F.year("at").alias("year"),
            F.month("at").alias("month"),
            F.dayofmonth("at").alias("day"),
            F.hour("at").alias("hour"),
            *["temp", "rhum", "prcp", "wdir", "wspd", "pres", "cldc", "coco", "wpgt", "temp_source"],
        )
    )


def monthly_arrivals(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Raw arrivals as two files that overlap by some days, all columns but one text.

    The schedule of an ``error`` event is unreadable; delays run past midnight.
    """
    actual = F.col("ts") + F.make_dt_interval(secs=F.floor((F.col("value") - 50.0) * 60.0).cast("decimal(18,6)"))
    style = "yyyy-MM-dd HH:mm:ss"
    rows = events(spark, folder).select(
        F.date_format("ts", "yyyy-MM-dd").alias("service_date"),
        F.when(F.col("event_type") == "error", "n/a")
        .otherwise(F.date_format("ts", style))
        .alias("scheduled"),
        F.date_format(actual, style).alias("actual"),
        (F.col("user_id") % 30).cast("string").alias("route_id"),
        (F.col("event_id") % 2).cast("string").alias("direction_id"),
        F.col("user_id").cast("string").alias("stop_id"),
        event_number().alias("time_point_order"),
        F.col("event_type").alias("point_type"),
    )
    first, second = F.col("service_date") <= "2024-01-20", F.col("service_date") >= "2024-01-15"
    return [rows.where(first), rows.where(second)]


def conditions(spark: SparkSession, folder: str) -> DataFrame:
    """Clean hourly weather."""
    return clean_conditions(raw_conditions(spark, folder))


def shipments(spark: SparkSession, folder: str) -> DataFrame:
    """Clean arrivals from order lines: ordered is scheduled, shipped is actual."""
    orders = read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("scheduled_dt"),
    )
    lines = read(spark, folder, "lineitem").withColumn(
        "actual_dt", F.col("l_shipdate").cast("timestamp_ntz")
    )
    return lines.join(orders, "l_orderkey").select(
        F.col("scheduled_dt").cast("date").alias("service_date"),
        (F.col("l_quantity").cast("int") % 24).alias("hour"),
        F.weekday("scheduled_dt").alias("weekday"),
        time.weekend_flag(F.weekday("scheduled_dt")).alias("is_weekend"),
        F.col("l_suppkey").cast("string").alias("route_id"),
        F.col("l_linestatus").alias("direction_id"),
        F.col("l_partkey").cast("string").alias("stop_id"),
        F.col("l_linenumber").alias("time_point_order"),
        F.col("l_returnflag").alias("point_type"),
        "scheduled_dt",
        "actual_dt",
        (F.date_diff(F.col("actual_dt").cast("date"), F.col("scheduled_dt").cast("date")) * 3.0).alias(
            "delay_seconds"
        ),
        (F.col("l_extendedprice") / 5000.0).alias("air_temp_c"),
        (F.col("l_quantity") * 2.0).alias("rel_humidity_pct"),
        (F.col("l_discount") * 10.0).alias("precip_mm"),
        (F.col("l_partkey") % 360).cast("double").alias("wind_dir_deg"),
        (F.col("l_tax") * 100.0).alias("wind_speed_kmh"),
        (F.lit(1000.0) + F.col("l_quantity")).alias("pressure_hpa"),
        (F.col("l_suppkey") % 9).cast("double").alias("cloud_cover"),
        condition_label((F.col("l_suppkey") % 30 + 1).cast("int")).alias("weather_condition"),
    )


def scored_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Trips with a score that has many ties."""
    p = F.col("time_point_order") / F.lit(99.0)
    return trips(spark, folder).select(
        "trip_id",
        "hour",
        (F.col("time_point_order") / F.lit(9.0)).alias("precip_mm"),
        (F.col("delay_minutes") >= 5.0).cast("int").alias("y_true"),
        (p >= 0.5).cast("int").alias("y_pred"),
        p.alias("y_proba"),
    )
