"""Queries for scans, cleaning, joins, functions, splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.functions import calendar, labels, numeric, text, time
from headway.operators import cleaning, features, splits
from headway.operators.profiles import preview
from headway.plans import tables as D
from headway.plans.oracle import HALF, HASH, label_case, pad, share_of_hash
from headway.plans.registry import query
from headway.sources import arrivals
from headway.sources.arrivals import union_by_name

RAW = "service_date, scheduled, actual, route_id, direction_id, stop_id, time_point_order, point_type"
TS = "strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"
DAY = "strftime(service_date, '%Y-%m-%d') AS service_date"


def weathered(spark, folder):
    return features.join_conditions(D.trips(spark, folder), D.conditions(spark, folder))


# ---- scans and set operations ----------------------------------------------


@query(f"SELECT {RAW} FROM raw_arrivals", ("raw_arrivals",))
def union_monthly_arrivals(spark, folder):
    return union_by_name(D.monthly_arrivals(spark, folder))


@query(f"SELECT DISTINCT {RAW} FROM raw_arrivals", ("raw_arrivals",))
def distinct_arrivals(spark, folder):
    return cleaning.distinct_rows(union_by_name(D.monthly_arrivals(spark, folder)))


@query(
    f"""SELECT {DAY}, hour, weekday, is_weekend, route_id, direction_id, stop_id, time_point_order,
    point_type, {TS.format(c="scheduled_dt")}, {TS.format(c="actual_dt")},
    round(delay_seconds, 6) AS delay_seconds, round(delay_minutes, 6) AS delay_minutes FROM clean""",
    ("clean",),
)
def clean_arrivals(spark, folder):
    return cleaning.clean_arrivals(union_by_name(D.monthly_arrivals(spark, folder)))


@query(
    """SELECT strftime(timestamp_hour, '%Y-%m-%d %H:%M:%S') AS timestamp_hour, round(air_temp_c, 6) AS air_temp_c,
    round(rel_humidity_pct, 6) AS rel_humidity_pct, round(precip_mm, 6) AS precip_mm, wind_dir_deg,
    round(wind_speed_kmh, 6) AS wind_speed_kmh, pressure_hpa, cloud_cover, weather_condition FROM conditions""",
    ("conditions",),
)
def clean_conditions(spark, folder):
    return D.conditions(spark, folder)


@query(
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_returnflag,
    round(l_quantity, 6) AS l_quantity FROM lineitem""",
)
def pruned_scan(spark, folder):
    return D.read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")


@query(
    f"""SELECT trip_id, stop_id, round(delay_minutes, 6) AS delay_minutes FROM
    (SELECT * FROM trips ORDER BY trip_id LIMIT 2500) WHERE {HASH.format(key="trip_id")} < {HALF}""",
    ("trips",),
)
def capped_sampled_scan(spark, folder):
    """The first rows by key, then a fraction of them."""
    scan = D.trips(spark, folder).select("trip_id", "stop_id", "delay_minutes")
    return splits.fraction_sample(splits.row_cap(scan, 2500, "trip_id"), "trip_id", 0.5)


@query(
    """SELECT trip_id, stop_id, round(delay_minutes, 6) AS delay_minutes
    FROM trips ORDER BY service_date, trip_id LIMIT 10""",
    ("trips",),
)
def preview_rows(spark, folder):
    rows = D.trips(spark, folder).select("service_date", "trip_id", "stop_id", "delay_minutes")
    return preview(rows, 10, "service_date", "trip_id").drop("service_date")


@query(
    f"SELECT {DAY}, route_id, stop_id, time_point_order FROM shipments",
    ("shipments",),
)
def sorted_by_date(spark, folder):
    rows = D.shipments(spark, folder).select("service_date", "route_id", "stop_id", "time_point_order")
    return rows.orderBy("service_date")


# ---- joins -----------------------------------------------------------------

WEATHER = """strftime(event_hour, '%Y-%m-%d %H:%M:%S') AS event_hour, round(air_temp_c, 6) AS air_temp_c,
    round(precip_mm, 6) AS precip_mm, wind_dir_deg, weather_condition"""


@query(f"SELECT trip_id, {WEATHER} FROM weathered", ("weathered",))
def trips_with_conditions(spark, folder):
    return weathered(spark, folder).select(
        "trip_id", "event_hour", "air_temp_c", "precip_mm", "wind_dir_deg", "weather_condition"
    )


@query(
    f"""SELECT trip_id, point_type, {WEATHER} FROM weathered
    WHERE point_type IS NOT NULL AND air_temp_c IS NOT NULL AND weather_condition IS NOT NULL""",
    ("weathered",),
)
def complete_trips(spark, folder):
    return cleaning.complete_rows(weathered(spark, folder)).select(
        "trip_id", "point_type", "event_hour", "air_temp_c", "precip_mm", "wind_dir_deg", "weather_condition"
    )


@query(
    "SELECT trip_id, point_type FROM trips WHERE point_type IS NOT NULL AND delay_minutes IS NOT NULL",
    ("trips",),
)
def named_column_drop(spark, folder):
    rows = cleaning.complete_rows(D.trips(spark, folder), ["point_type", "delay_minutes"])
    return rows.select("trip_id", "point_type")


@query(
    f"""SELECT l_suppkey % 30 + 1 AS code, {label_case("l_suppkey % 30 + 1")} AS weather_condition,
    count(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def condition_labels(spark, folder):
    code = F.col("l_suppkey") % 30 + 1
    rows = D.read(spark, folder, "lineitem").select(code.alias("code"))
    return rows.withColumn("weather_condition", cleaning.condition_label(F.col("code").cast("int"))).groupBy(
        "code", "weather_condition"
    ).agg(F.count(F.lit(1)).alias("n"))


# ---- filters and numbers ---------------------------------------------------


@query(
    "SELECT trip_id, round(delay_seconds, 6) AS delay_seconds FROM trips WHERE delay_seconds BETWEEN -7200 AND 7200",
    ("trips",),
)
def valid_delays(spark, folder):
    return cleaning.valid_delays(D.trips(spark, folder)).select("trip_id", "delay_seconds")


@query(
    """SELECT count(*) AS rows_total, count(*) FILTER (delay_seconds BETWEEN -7200 AND 7200) AS rows_valid,
    count(*) FILTER (NOT coalesce(delay_seconds BETWEEN -7200 AND 7200, FALSE)) AS rows_rejected FROM trips""",
    ("trips",),
)
def rejected_delays(spark, folder):
    return cleaning.rejected_delays(D.trips(spark, folder))


@query(
    """SELECT trip_id, TRY_CAST(t AS BIGINT) AS whole_number, round(CAST(CAST(d AS FLOAT) AS DOUBLE), 6) AS narrow
    FROM (SELECT event_id AS trip_id, CASE event_type WHEN 'error' THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS t,
    value AS d FROM events)""",
)
def numeric_coercion(spark, folder):
    rows = D.events(spark, folder).select(
        F.col("event_id").alias("trip_id"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("user_id").cast("string")).alias("t"),
        "value",
    )
    return rows.select(
        "trip_id",
        numeric.to_number(F.col("t"), "long").alias("whole_number"),
        numeric.to_number(F.col("value"), "float").alias("narrow"),
    )


@query(
    """SELECT event_id AS trip_id, CASE WHEN event_type IN ('error', 'view', 'click') THEN NULL
    ELSE round(value, 6) END AS value FROM events""",
)
def finite_values(spark, folder):
    odd = F.create_map(
        F.lit("error"), F.lit(float("inf")), F.lit("view"), F.lit(float("nan")), F.lit("click"), F.lit(-float("inf"))
    )
    rows = D.events(spark, folder).select(
        F.col("event_id").alias("trip_id"), F.coalesce(odd[F.col("event_type")], F.col("value")).alias("value")
    )
    return cleaning.finite_columns(rows)


@query(
    """SELECT trip_id, round(least(greatest(delay_minutes, -10.0), 30.0), 6) AS delay_minutes_clipped,
    round(least(greatest(delay_seconds, -7200.0), 7200.0), 6) AS delay_sec_clipped FROM trips""",
    ("trips",),
)
def clipped_delays(spark, folder):
    return D.trips(spark, folder).select(
        "trip_id",
        numeric.clip(F.col("delay_minutes"), -10.0, 30.0).alias("delay_minutes_clipped"),
        numeric.clip(F.col("delay_seconds"), -7200.0, 7200.0).alias("delay_sec_clipped"),
    )


# ---- scalar functions ------------------------------------------------------


@query(
    """SELECT trip_id, strftime(date_trunc('hour', actual_dt), '%Y-%m-%d %H:%M:%S') AS event_hour,
    hour, weekday, is_weekend FROM trips""",
    ("trips",),
)
def hour_floor(spark, folder):
    rows = D.trips(spark, folder)
    return rows.select("trip_id", time.floor_hour(F.col("actual_dt")).alias("event_hour"), "hour", "weekday", "is_weekend")


CALENDAR = """CAST(month(d) AS BIGINT) AS month, CAST(dayofyear(d) AS BIGINT) AS day_of_year,
    CAST(floor((month(d) % 12 + 3) / 3) AS BIGINT) AS season,
    CAST(CASE WHEN (month(d) = 1 AND day(d) >= 15) OR month(d) BETWEEN 2 AND 4 OR (month(d) = 5 AND day(d) <= 15)
         OR month(d) BETWEEN 9 AND 11 OR (month(d) = 12 AND day(d) <= 20) THEN 1 ELSE 0 END AS BIGINT) AS is_school_in_session"""


@query(
    f"""SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS service_date, {CALENDAR},
    CAST(CASE WHEN h.day IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS is_holiday
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders) LEFT JOIN holidays h ON h.day = d""",
    ("holidays",),
)
def calendar_features(spark, folder):
    rows = D.read(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("service_date"))
    return features.add_calendar(rows)


@query(
    """SELECT strftime(day, '%Y-%m-%d') AS holiday_date, CAST(count(o_orderkey) AS BIGINT) AS n_orders
    FROM holidays LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day
    WHERE day BETWEEN (SELECT make_date(CAST(min(year(o_orderdate)) AS INTEGER), 1, 1) FROM orders)
    AND (SELECT make_date(CAST(max(year(o_orderdate)) AS INTEGER), 12, 31) FROM orders) GROUP BY 1""",
    ("holidays",),
)
def holiday_traffic(spark, folder):
    """Orders on each holiday of the years in the data."""
    orders = D.read(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("service_date"))
    years = features.year_range(orders).first()
    days = calendar.holiday_table(spark, years["first_year"], years["last_year"])
    per_day = orders.where(calendar.is_us_holiday(F.col("service_date"))).groupBy("service_date").agg(
        F.count(F.lit(1)).alias("n")
    )
    return days.join(per_day, days["holiday_date"] == per_day["service_date"], "left").select(
        "holiday_date", F.coalesce("n", F.lit(0)).alias("n_orders")
    )


@query(
    """SELECT CAST(min(year(service_date)) AS BIGINT) AS first_year, CAST(max(year(service_date)) AS BIGINT) AS last_year
    FROM shipments""",
    ("shipments",),
)
def date_year_range(spark, folder):
    return features.year_range(D.shipments(spark, folder))


@query(
    """SELECT trip_id, CASE WHEN delay_seconds <= -300 THEN 'early' WHEN delay_seconds <= 300 THEN 'on-time'
    WHEN delay_seconds > 300 THEN 'delayed' END AS label_mc,
    CAST(CASE WHEN delay_seconds > 300 THEN 1 ELSE 0 END AS BIGINT) AS label,
    CAST(CASE WHEN delay_minutes >= 5.0 THEN 1 ELSE 0 END AS BIGINT) AS late_5,
    CAST(CASE WHEN delay_minutes >= 1.0 THEN 1 ELSE 0 END AS BIGINT) AS late_1 FROM trips""",
    ("trips",),
)
def delay_labels(spark, folder):
    three = labels.three_way_label(F.col("delay_seconds"))
    return D.trips(spark, folder).select(
        "trip_id",
        three.alias("label_mc"),
        labels.delayed_class(three).alias("label"),
        labels.late_by(F.col("delay_minutes"), 5.0).alias("late_5"),
        labels.late_by(F.col("delay_minutes"), 1.0).alias("late_1"),
    )


@query(
    """SELECT trip_id, CAST(CASE WHEN coalesce(precip_mm, 0) > 0.2 AND (coalesce(hour, -1) BETWEEN 7 AND 9
    OR coalesce(hour, -1) BETWEEN 16 AND 18) THEN 1 ELSE 0 END AS BIGINT) AS rainy_rush_hour,
    round(sin(radians(wind_dir_deg)), 6) AS wind_dir_sin, round(cos(radians(wind_dir_deg)), 6) AS wind_dir_cos,
    round(sin(radians(coalesce(wind_dir_deg, 0))), 6) AS filled_sin,
    round(cos(radians(coalesce(wind_dir_deg, 0))), 6) AS filled_cos FROM weathered""",
    ("weathered",),
)
def weather_functions(spark, folder):
    sine, cosine = numeric.wind_parts(F.col("wind_dir_deg"))
    filled_sine, filled_cosine = numeric.wind_parts(F.col("wind_dir_deg"), fill_missing=True)
    return weathered(spark, folder).select(
        "trip_id",
        numeric.rainy_rush_hour(F.col("precip_mm"), F.col("hour")).alias("rainy_rush_hour"),
        sine.alias("wind_dir_sin"),
        cosine.alias("wind_dir_cos"),
        filled_sine.alias("filled_sin"),
        filled_cosine.alias("filled_cos"),
    )


@query(
    f"""SELECT trip_id, {pad("stop_id")} AS padded, coalesce(nullif(trim(kind), ''), '<missing>') AS category,
    CASE WHEN kind IS NULL THEN '<missing>' WHEN trim(kind) = '' THEN 'Unknown' ELSE trim(kind) END AS legacy FROM
    (SELECT trip_id, stop_id, CASE point_type WHEN 'view' THEN '  ' WHEN 'click' THEN ' click ' ELSE point_type END AS kind
    FROM trips)""",
    ("trips",),
)
def text_functions(spark, folder):
    kind = (
        F.when(F.col("point_type") == "view", "  ")
        .when(F.col("point_type") == "click", " click ")
        .otherwise(F.col("point_type"))
    )
    return D.trips(spark, folder).select(
        "trip_id",
        text.pad_two(F.col("stop_id")).alias("padded"),
        text.category(kind).alias("category"),
        text.legacy_category(kind).alias("legacy"),
    )


@query(
    """SELECT trip_id, round(abs(z), 6) AS magnitude, round(p, 6) AS probability,
    round(-(y * ln(p + 1e-12) + (1 - y) * ln(1 - p + 1e-12)), 6) AS loss FROM
    (SELECT trip_id, z, y, 1 / (1 + exp(-z)) AS p FROM (SELECT trip_id, delay_minutes / 100.0 AS z,
    CASE WHEN delay_minutes >= 5.0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS y FROM trips))""",
    ("trips",),
)
def score_functions(spark, folder):
    z = F.col("delay_minutes") / 100.0
    y = (F.col("delay_minutes") >= 5.0).cast("double")
    return D.trips(spark, folder).select(
        "trip_id",
        F.abs(z).alias("magnitude"),
        numeric.sigmoid(z).alias("probability"),
        numeric.log_loss(y, numeric.sigmoid(z)).alias("loss"),
    )


@query(
    f"""SELECT trip_id, {DAY}, round(CAST(CAST(air_temp_c AS FLOAT) AS DOUBLE), 6) AS air_temp_c,
    round(CAST(CAST(precip_mm AS FLOAT) AS DOUBLE), 6) AS precip_mm, CAST(hour AS DOUBLE) AS hour,
    CAST(month(service_date) AS DOUBLE) AS month, CAST(floor((month(service_date) % 12 + 3) / 3) AS BIGINT) AS season,
    CAST(CASE WHEN h.day IS NOT NULL THEN 1 ELSE 0 END AS DOUBLE) AS is_holiday,
    CAST(CASE WHEN coalesce(precip_mm, 0) > 0.2 AND (hour BETWEEN 7 AND 9 OR hour BETWEEN 16 AND 18)
    THEN 1 ELSE 0 END AS DOUBLE) AS rainy_rush_hour, round(delay_seconds, 6) AS delay_sec_clipped,
    CASE WHEN delay_seconds <= -300 THEN 'early' WHEN delay_seconds <= 300 THEN 'on-time' ELSE 'delayed' END AS label_mc,
    CAST(CASE WHEN delay_seconds > 300 THEN 1 ELSE 0 END AS BIGINT) AS label
    FROM weathered LEFT JOIN holidays h ON h.day = service_date WHERE delay_seconds BETWEEN -7200 AND 7200""",
    ("weathered", "holidays"),
)
def processed_trips(spark, folder):
    return features.processed_table(weathered(spark, folder), clipped_delay=True).select(
        "trip_id", "service_date", "air_temp_c", "precip_mm", "hour", "month", "season", "is_holiday",
        "rainy_rush_hour", "delay_sec_clipped", "label_mc", "label",
    )


@query(
    """SELECT trip_id, route_id, coalesce(point_type, '<missing>') AS point_type,
    coalesce(weather_condition, '<missing>') AS weather_condition, '1' AS season,
    CAST(CASE WHEN delay_minutes >= 1.0 THEN 1 ELSE 0 END AS BIGINT) AS is_delayed,
    round(sin(radians(wind_dir_deg)), 4) AS wind_dir_sin
    FROM weathered WHERE delay_seconds BETWEEN -7200 AND 7200""",
    ("weathered",),
)
def linear_features(spark, folder):
    table = features.linear_features(features.processed_table(weathered(spark, folder)), 1.0)
    return table.select(
        "trip_id", "route_id", "point_type", "weather_condition", "season", "is_delayed",
        F.round("wind_dir_sin", 4).alias("wind_dir_sin"),
    )


# ---- splits and samples ----------------------------------------------------


@query(
    f"""SELECT {DAY}, route_id, stop_id, time_point_order, split FROM labelled""",
    ("labelled",),
)
def dated_splits(spark, folder):
    rows = cleaning.valid_delays(D.shipments(spark, folder))
    return splits.dated_splits(rows, D.SHIPMENT_SPLITS).select(
        "service_date", "route_id", "stop_id", "time_point_order", "split"
    )


@query(
    """SELECT trip_id, CASE WHEN service_date < DATE '2024-01-21' THEN 'before' ELSE 'after' END AS side FROM trips""",
    ("trips",),
)
def split_at_date(spark, folder):
    before, after = splits.split_at(D.trips(spark, folder), D.TRIP_SPLIT)
    return before.select("trip_id", F.lit("before").alias("side")).unionByName(
        after.select("trip_id", F.lit("after").alias("side"))
    )


@query(
    f"""SELECT trip_id, y, CAST(CASE WHEN rn <= round(n * CAST(0.2 AS DOUBLE)) THEN 1 ELSE 0 END AS BIGINT) AS is_test
    FROM (SELECT trip_id, y, row_number() OVER (PARTITION BY y ORDER BY {HASH.format(key="trip_id")}, trip_id) AS rn,
    count(*) OVER (PARTITION BY y) AS n FROM (SELECT trip_id,
    CAST(CASE WHEN delay_minutes >= 5.0 THEN 1 ELSE 0 END AS BIGINT) AS y FROM trips))""",
    ("trips",),
)
def stratified_holdout(spark, folder):
    rows = D.trips(spark, folder).select("trip_id", (F.col("delay_minutes") >= 5.0).cast("int").alias("y"))
    return splits.stratified_holdout(rows, "y", "trip_id")


@query("SELECT trip_id, stop_id FROM trips ORDER BY trip_id LIMIT 1000", ("trips",))
def row_cap(spark, folder):
    return splits.row_cap(D.trips(spark, folder).select("trip_id", "stop_id"), 1000, "trip_id")


@query(
    f"SELECT trip_id, stop_id FROM trips WHERE {HASH.format(key='trip_id')} < {share_of_hash(0.3)}", ("trips",)
)
def fraction_sample(spark, folder):
    return splits.fraction_sample(D.trips(spark, folder).select("trip_id", "stop_id"), "trip_id", 0.3)


@query(f"SELECT trip_id, stop_id FROM trips ORDER BY {HASH.format(key='trip_id')}, trip_id LIMIT 700", ("trips",))
def fixed_size_sample(spark, folder):
    return splits.fixed_sample(D.trips(spark, folder).select("trip_id", "stop_id"), "trip_id", 700)


@query(
    f"""SELECT trip_id, route_id, stop_id FROM trips
    WHERE {HASH.format(key="route_id || '|' || stop_id || '|' || trip_id")} < {share_of_hash(0.25)}""",
    ("trips",),
)
def fraction_sample_text_keys(spark, folder):
    """A sample by several key columns, two of them text."""
    rows = D.trips(spark, folder).select("trip_id", "route_id", "stop_id")
    return splits.fraction_sample(rows, ["route_id", "stop_id", "trip_id"], 0.25)


@query(
    f"""SELECT trip_id, point_type, CAST(CASE WHEN rn <= round(n * 0.2) THEN 1 ELSE 0 END AS BIGINT) AS is_test
    FROM (SELECT trip_id, point_type, row_number() OVER (PARTITION BY point_type ORDER BY
          {HASH.format(key="trip_id")}, CAST(trip_id AS VARCHAR)) AS rn, count(*) OVER (PARTITION BY point_type) AS n
          FROM trips)""",
    ("trips",),
)
def stratified_holdout_text(spark, folder):
    """A hold-out by a text key over text classes; trips without a class are one more class."""
    rows = D.trips(spark, folder).select("trip_id", "point_type", F.col("trip_id").cast("string").alias("key"))
    return splits.stratified_holdout(rows, "point_type", "key").drop("key")


@query(
    """SELECT event_id, user_id AS whole, CAST(round(value, 2) AS BIGINT) AS rounded
    FROM (SELECT event_id, user_id, CASE WHEN round(value, 2) = floor(round(value, 2)) THEN value END AS value FROM events)""",
)
def float_text_integers(spark, folder):
    """Whole numbers written as 8.0 are whole numbers; other decimals are no value of the type."""
    text = D.read(spark, folder, "events").select(
        "event_id",
        F.concat(F.col("user_id").cast("string"), F.lit(".0")).alias("whole"),
        F.round("value", 2).cast("string").alias("rounded"),
    )
    return arrivals.typed(text, {"whole": T.LongType(), "rounded": T.LongType()})



@query("SELECT split, count(*) AS n_rows, count(DISTINCT label) AS n_classes FROM labelled GROUP BY 1", ("labelled",))
def split_guards(spark, folder):
    return splits.split_sizes(labelled_shipments(spark, folder), "label")


@query(
    f"""SELECT {DAY}, route_id, stop_id, CAST(time_point_order AS DOUBLE) AS time_point_order, label FROM labelled WHERE split IN ('train', 'val')""",
    ("labelled",),
)
def final_training_rows(spark, folder):
    return splits.training_rows(labelled_shipments(spark, folder), 2).select(
        "service_date", "route_id", "stop_id", "time_point_order", "label"
    )


def labelled_shipments(spark, folder):
    rows = features.processed_table(D.shipments(spark, folder))
    return splits.dated_splits(rows, D.SHIPMENT_SPLITS)


