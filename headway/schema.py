"""Column names, code lists and types shared by every module.

The names, codes, labels and dates below are fixed values: results only agree
with the published data product when they are spelled exactly like this.
"""

from pyspark.sql import types as T

# ---- fixed values: table layouts -------------------------------------------

RAW_ARRIVAL_COLUMNS = [
    "service_date", "scheduled", "actual", "route_id", "direction_id",
    "stop_id", "time_point_order", "point_type",
]

CLEAN_ARRIVAL_COLUMNS = [
    "service_date", "hour", "weekday", "is_weekend", "route_id", "direction_id",
    "stop_id", "time_point_order", "point_type", "scheduled_dt", "actual_dt",
    "delay_seconds", "delay_minutes",
]

CONDITION_COLUMNS = {
    "temp": "air_temp_c",
    "rhum": "rel_humidity_pct",
    "prcp": "precip_mm",
    "wdir": "wind_dir_deg",
    "wspd": "wind_speed_kmh",
    "pres": "pressure_hpa",
    "cldc": "cloud_cover",
    "coco": "weather_condition",
}

# What tells one arrival from another; samples are drawn by a hash of these.
ARRIVAL_KEYS = [
    "service_date", "route_id", "direction_id", "stop_id", "time_point_order", "actual_dt",
]

ID_COLUMNS = ["route_id", "direction_id", "stop_id", "point_type", "weather_condition"]

# ---- fixed values: feature groups ------------------------------------------

PROCESSED_NUMERIC = [
    "hour", "weekday", "is_weekend", "time_point_order", "air_temp_c",
    "rel_humidity_pct", "precip_mm", "wind_dir_deg", "wind_speed_kmh",
    "pressure_hpa", "cloud_cover", "month", "day_of_year", "is_holiday",
    "is_school_in_session", "rainy_rush_hour",
]

LINEAR_NUMERIC = [
    "hour", "weekday", "is_weekend", "time_point_order", "air_temp_c",
    "rel_humidity_pct", "precip_mm", "wind_speed_kmh", "pressure_hpa",
    "cloud_cover", "wind_dir_sin", "wind_dir_cos", "month", "day_of_year",
    "is_holiday", "is_school_in_session", "rainy_rush_hour",
]
LINEAR_CATEGORICAL = [
    "route_id", "stop_id", "direction_id", "point_type", "weather_condition", "season",
]

ROUTE_HOUR_KEYS = ["route_id", "hour", "weekday"]
ROUTE_HOUR_STATS = [
    "route_hour_delay_mean", "route_hour_delay_median", "route_hour_delay_count",
]
NOTEBOOK_NUMERIC = LINEAR_NUMERIC + ROUTE_HOUR_STATS
NOTEBOOK_PARSED = [
    "hour", "weekday", "is_weekend", "time_point_order", "air_temp_c", "rel_humidity_pct",
    "precip_mm", "wind_dir_deg", "wind_speed_kmh", "pressure_hpa", "cloud_cover",
    "delay_minutes",
]
NOTEBOOK_CATEGORICAL = [
    "route_id", "direction_id", "point_type", "weather_condition", "season",
]

LEGACY_NUMERIC = [
    "hour", "weekday", "is_weekend", "time_point_order", "air_temp_c",
    "rel_humidity_pct", "precip_mm", "wind_speed_kmh", "pressure_hpa",
    "cloud_cover", "wind_dir_sin", "wind_dir_cos",
]
LEGACY_CATEGORICAL = ["route_id", "direction_id", "point_type", "weather_condition"]

TARGET_ENCODED = ["route_id", "stop_id"]
ORDINAL_ENCODED = ["direction_id", "point_type", "weather_condition", "season"]

HISTOGRAM_COLUMNS = [
    "hour", "weekday", "time_point_order", "air_temp_c", "rel_humidity_pct", "precip_mm",
    "wind_speed_kmh", "pressure_hpa", "cloud_cover",
]
CATEGORY_LIMITS = {
    "route_id": 15, "stop_id": 15, "point_type": None, "direction_id": None, "weather_condition": 15,
}
BOX_COLUMNS = ["air_temp_c", "precip_mm", "wind_speed_kmh", "cloud_cover"]

# ---- fixed values: weather codes -------------------------------------------

CONDITION_LABELS = {
    1: "Clear",
    2: "Fair",
    3: "Cloudy",
    4: "Overcast",
    5: "Fog",
    6: "Freezing Fog",
    7: "Light Rain",
    8: "Rain",
    9: "Heavy Rain",
    10: "Freezing Rain",
    11: "Heavy Freezing Rain",
    12: "Sleet",
    13: "Heavy Sleet",
    14: "Light Snowfall",
    15: "Snowfall",
    16: "Heavy Snowfall",
    17: "Rain Shower",
    18: "Heavy Rain Shower",
    19: "Sleet Shower",
    20: "Heavy Sleet Shower",
    21: "Snow Shower",
    22: "Heavy Snow Shower",
    23: "Lightning",
    24: "Hail",
    25: "Thunderstorm",
    26: "Heavy Thunderstorm",
    27: "Storm",
}

WEEKDAY_LABELS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]

# ---- fixed values: limits and edges ----------------------------------------

MISSING = "<missing>"
OTHER = "other"
VALID_DELAY_SECONDS = 7200.0
TOLERANCE_SECONDS = 300.0
RAIN_MM = 0.2
HEATMAP_DAYS = 21
HOUR_SLICE_EDGES = [0, 3, 6, 9, 12, 15, 18, 21, 24]
RAIN_SLICE_EDGES = [-0.01, 0.0, 0.5, 1.0, 2.0, 5.0, 10.0]
SPLIT_DATES = ("2023-01-01", "2023-10-01", "2024-01-01", "2025-01-01")

# ---- Spark types -----------------------------------------------------------

RAW_ARRIVAL_SCHEMA = T.StructType(
    [
        T.StructField(name, T.IntegerType() if name == "time_point_order" else T.StringType())
        for name in RAW_ARRIVAL_COLUMNS
    ]
)

CLEAN_ARRIVAL_TYPES = {
    "service_date": T.DateType(),
    "hour": T.IntegerType(),
    "weekday": T.IntegerType(),
    "is_weekend": T.IntegerType(),
    "time_point_order": T.IntegerType(),
    "scheduled_dt": T.TimestampNTZType(),
    "actual_dt": T.TimestampNTZType(),
    "delay_seconds": T.DoubleType(),
    "delay_minutes": T.DoubleType(),
}

CLEAN_ARRIVAL_SCHEMA = T.StructType(
    [
        T.StructField(name, CLEAN_ARRIVAL_TYPES.get(name, T.StringType()))
        for name in CLEAN_ARRIVAL_COLUMNS
    ]
)

INTEGRATED_SCHEMA = T.StructType(
    CLEAN_ARRIVAL_SCHEMA.fields
    + [T.StructField("event_hour", T.TimestampNTZType())]
    + [
        T.StructField(
            name, T.StringType() if name == "weather_condition" else T.DoubleType()
        )
        for name in CONDITION_COLUMNS.values()
    ]
)
