"""Queries for the report tables and the evaluation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from headway import schema as S
from headway.functions.numeric import clip
from headway.operators import metrics, profiles
from headway.operators.features import attach_route_hour_stats, route_hour_stats as route_hour_table
from headway.operators.splits import split_at
from headway.plans import tables as D
from headway.plans.oracle import right_closed
from headway.plans.registry import query
from headway.plans.table_queries import labelled_shipments, weathered


def late_trips(spark, folder):
    """Trips with weather and the five-minute label."""
    return weathered(spark, folder).withColumn("is_delayed", (F.col("delay_minutes") >= 5.0).cast("int"))


def labelled_trips(spark, folder):
    """Trips with the five-minute label, without their weather."""
    return D.trips(spark, folder).withColumn("is_delayed", (F.col("delay_minutes") >= 5.0).cast("int"))


LATE = "CAST(CASE WHEN delay_minutes >= 5.0 THEN 1 ELSE 0 END AS BIGINT)"

# ---- delays by driver ------------------------------------------------------


@query(
    f"""SELECT hour, round(avg(delay_minutes), 6) AS mean_delay, count(delay_minutes) AS n_trips,
    round(avg({LATE}), 6) AS delay_rate, round(avg(air_temp_c), 6) AS mean_temp
    FROM weathered GROUP BY hour""",
    ("weathered",),
)
def hourly_profile(spark, folder):
    return profiles.hourly_profile(late_trips(spark, folder), mean_temp="air_temp_c")


@query(
    f"""SELECT CAST(hour AS BIGINT) AS hour, round(avg(delay_seconds / 60.0), 6) AS mean_delay,
    count(delay_seconds) AS n_trips,
    round(avg(CAST(CASE WHEN delay_seconds > 300.0 THEN 1 ELSE 0 END AS BIGINT)), 6) AS delay_rate
    FROM labelled GROUP BY hour""",
    ("labelled",),
)
def hourly_profile_shipments(spark, folder):
    return profiles.hourly_profile(labelled_shipments(spark, folder), "label").withColumn(
        "hour", F.col("hour").cast("long")
    )


@query(
    """SELECT hour, count(*) AS trip_count, round(median(delay_seconds / 60.0), 6) AS median_delay
    FROM shipments WHERE delay_seconds IS NOT NULL GROUP BY hour HAVING count(*) >= 500""",
    ("shipments",),
)
def hourly_median(spark, folder):
    rows = D.shipments(spark, folder)
    return profiles.hourly_median(rows.withColumn("delay_minutes", F.col("delay_seconds") / 60.0))


@query(
    """SELECT weekday, round(avg(delay_minutes), 6) AS mean_delay,
    list_extract(['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'], weekday % 7 + 1) AS weekday_label
    FROM trips GROUP BY weekday""",
    ("trips",),
)
def weekday_profile(spark, folder):
    return profiles.weekday_profile(D.trips(spark, folder))


@query(
    """SELECT weather_condition, round(mean_delay, 6) AS mean_delay FROM (SELECT weather_condition,
    avg(delay_minutes) AS mean_delay FROM weathered WHERE weather_condition IS NOT NULL GROUP BY 1)
    ORDER BY mean_delay DESC, weather_condition LIMIT 10""",
    ("weathered",),
)
def condition_ranking(spark, folder):
    return profiles.condition_ranking(weathered(spark, folder))


@query(
    f"""SELECT route_id, round(delay_rate, 6) AS delay_rate, n_trips FROM (SELECT route_id, avg({LATE}) AS delay_rate,
    count(*) AS n_trips FROM trips GROUP BY 1) ORDER BY delay_rate DESC, route_id LIMIT 15""",
    ("trips",),
)
def route_ranking(spark, folder):
    return profiles.route_ranking(labelled_trips(spark, folder))


@query(
    f"""SELECT CAST(rain_bin AS BIGINT) AS rain_bin, round(avg(late), 6) AS delay_rate,
    round(avg(delay_minutes), 6) AS mean_delay, count(*) AS n_trips FROM
    (SELECT {right_closed("least(greatest(precip_mm, 0.0), 10.0)", range(11))} AS rain_bin, {LATE} AS late, delay_minutes
    FROM weathered WHERE precip_mm IS NOT NULL) GROUP BY 1""",
    ("weathered",),
)
def rain_profile(spark, folder):
    return profiles.rain_profile(late_trips(spark, folder))


HOURS = ", ".join(
    f"round(avg(delay_minutes) FILTER (hour = {h}), 6) AS hour_{h}" for h in range(24)
)


@query(
    f"""SELECT strftime(service_date, '%Y-%m-%d') AS service_date, {HOURS} FROM trips
    GROUP BY service_date ORDER BY service_date DESC LIMIT 21""",
    ("trips",),
)
def service_heatmap(spark, folder):
    return profiles.service_heatmap(D.trips(spark, folder))


@query(
    """SELECT route_id, hour, weekday, round(mean_delay, 6) AS route_hour_delay_mean,
    round(median_delay, 6) AS route_hour_delay_median, n_delay AS route_hour_delay_count FROM route_stats""",
    ("route_stats",),
)
def route_hour_stats(spark, folder):
    train, _ = split_at(D.trips(spark, folder), D.TRIP_SPLIT)
    return route_hour_table(train)


@query(
    """SELECT trip_id,
    round(coalesce(s.mean_delay, (SELECT median(a.mean_delay) FROM route_stats a JOIN trips b USING (route_id, hour, weekday)
      WHERE b.service_date < DATE '2024-01-21')), 6) AS route_hour_delay_mean,
    round(coalesce(s.median_delay, (SELECT median(a.median_delay) FROM route_stats a JOIN trips b USING (route_id, hour, weekday)
      WHERE b.service_date < DATE '2024-01-21')), 6) AS route_hour_delay_median,
    round(coalesce(s.n_delay, (SELECT median(a.n_delay) FROM route_stats a JOIN trips b USING (route_id, hour, weekday)
      WHERE b.service_date < DATE '2024-01-21')), 6) AS route_hour_delay_count
    FROM trips LEFT JOIN route_stats s USING (route_id, hour, weekday) WHERE service_date >= DATE '2024-01-21'""",
    ("route_stats",),
)
def route_hour_features(spark, folder):
    """Test rows with train statistics, gaps filled with the train medians."""
    train, test = split_at(D.trips(spark, folder), D.TRIP_SPLIT)
    _, test = attach_route_hour_stats(train, test)
    return test.select("trip_id", *S.ROUTE_HOUR_STATS)


# ---- frequencies, overviews, summaries -------------------------------------

TOP = """(SELECT '{c}' AS "column", {c} AS value, count(*) AS n FROM weathered WHERE {c} IS NOT NULL
    GROUP BY {c} ORDER BY n DESC, value LIMIT {k})"""


@query(
    " UNION ALL ".join(
        TOP.format(c=c, k=k or 10**9)
        for c, k in S.CATEGORY_LIMITS.items()
    ),
    ("weathered",),
)
def category_frequencies(spark, folder):
    return profiles.category_frequencies(weathered(spark, folder), S.CATEGORY_LIMITS)


@query(f"SELECT {LATE} AS is_delayed, count(*) AS n FROM trips GROUP BY 1", ("trips",))
def label_counts(spark, folder):
    return profiles.label_counts(labelled_trips(spark, folder), "is_delayed")


@query(
    """SELECT split, label, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY split) AS DOUBLE), 6) AS share
    FROM labelled GROUP BY split, label""",
    ("labelled",),
)
def class_shares(spark, folder):
    return profiles.class_shares(labelled_shipments(spark, folder), "label")


@query(
    """SELECT count(*) AS rows_total, count(*) FILTER (split = 'train') AS rows_train,
    count(*) FILTER (split = 'val') AS rows_val, count(*) FILTER (split = 'test') AS rows_test,
    count(*) FILTER (split <> 'test') AS rows_train_val FROM labelled""",
    ("labelled",),
)
def split_counts(spark, folder):
    rows = labelled_shipments(spark, folder)
    return rows.agg(
        F.count(F.lit(1)).alias("rows_total"),
        *[F.count_if(F.col("split") == s).alias(f"rows_{s}") for s in ("train", "val", "test")],
        F.count_if(F.col("split") != "test").alias("rows_train_val"),
    )


@query(
    f"""SELECT count(*) AS n_rows, CAST(sum({LATE}) AS BIGINT) AS n_positive, round(avg({LATE}), 6) AS positive_rate FROM trips""",
    ("trips",),
)
def positive_rate(spark, folder):
    return profiles.positive_rate(labelled_trips(spark, folder), "is_delayed")


OVERVIEW = {
    "trip_id": "bigint", "service_date": "date", "hour": "int", "weekday": "int", "is_weekend": "int",
    "route_id": "string", "direction_id": "string", "stop_id": "string", "time_point_order": "int",
    "point_type": "string", "actual_dt": "timestamp_ntz", "delay_seconds": "double", "delay_minutes": "double",
    "event_hour": "timestamp_ntz", "air_temp_c": "double", "rel_humidity_pct": "double", "precip_mm": "double",
    "wind_dir_deg": "double", "wind_speed_kmh": "double", "pressure_hpa": "double", "cloud_cover": "double",
    "weather_condition": "string",
}


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null, count(DISTINCT {c}) AS n_unique FROM weathered"""
        for c, t in OVERVIEW.items()
    ),
    ("weathered",),
)
def column_overview(spark, folder):
    return profiles.column_overview(weathered(spark, folder))


@query(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS n_missing FROM weathered""" for c in OVERVIEW
    ) + ") WHERE n_missing > 0",
    ("weathered",),
)
def missing_counts(spark, folder):
    return profiles.missing_counts(weathered(spark, folder))


SUMMARY = ["delay_minutes", "air_temp_c", "precip_mm", "wind_speed_kmh", "cloud_cover", "hour"]


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
        round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max,
        round(CAST(quantile_cont({c}, 0.25) AS DOUBLE), 6) AS q25, round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 6) AS q50,
        round(CAST(quantile_cont({c}, 0.75) AS DOUBLE), 6) AS q75 FROM weathered"""
        for c in SUMMARY
    ),
    ("weathered",),
)
def numeric_summary(spark, folder):
    return profiles.numeric_summary(weathered(spark, folder), SUMMARY)


BOX = "SELECT {late} AS is_delayed, '{c}' AS \"column\", {c} AS value FROM weathered WHERE {c} IS NOT NULL"


@query(
    f"""SELECT is_delayed, "column", round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
    round(min(value), 6) AS whisker_low, round(max(value), 6) AS whisker_high FROM
    (SELECT *, quantile_cont(value, 0.25) OVER w AS q1, quantile_cont(value, 0.5) OVER w AS med,
            quantile_cont(value, 0.75) OVER w AS q3
     FROM ({" UNION ALL ".join(BOX.format(late=LATE, c=c) for c in S.BOX_COLUMNS)})
     WINDOW w AS (PARTITION BY is_delayed, "column"))
    WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY is_delayed, "column", q1, med, q3""",
    ("weathered",),
)
def box_statistics(spark, folder):
    return profiles.box_statistics(late_trips(spark, folder))


# ---- histograms ------------------------------------------------------------

CLIPPED = "least(greatest(delay_minutes, -10.0), 30.0)"


@query(
    f"""SELECT b AS bin, round(lo + b * ((hi - lo) / 40), 6) AS bin_start, coalesce(n, 0) AS n FROM range(40) r(b)
    CROSS JOIN (SELECT min({CLIPPED}) AS lo, max({CLIPPED}) AS hi FROM trips) LEFT JOIN
    (SELECT least(CAST(floor(({CLIPPED} - lo) / (hi - lo) * 40) AS BIGINT), 39) AS k, count(*) AS n FROM trips,
     (SELECT min({CLIPPED}) AS lo, max({CLIPPED}) AS hi FROM trips) GROUP BY 1) ON k = b""",
    ("trips",),
)
def delay_histogram(spark, folder):
    return profiles.histogram(clipped_trips(spark, folder), "delay_minutes_clipped", 40)


def clipped_trips(spark, folder):
    return D.trips(spark, folder).withColumn("delay_minutes_clipped", clip(F.col("delay_minutes"), -10.0, 30.0))


@query(
    f"""SELECT p AS point, round(lo + p * ((hi - lo) / 199), 6) AS x,
    round(sum(n * exp(-0.5 * pow((lo + p * ((hi - lo) / 199) - c) / h, 2))) / (any_value(total) * any_value(h) * sqrt(2 * pi())), 6) AS density
    FROM range(200) r(p) CROSS JOIN
    (SELECT k, n, lo, hi, total, h, lo + k * ((hi - lo) / 40) + (hi - lo) / 40 / 2 AS c FROM
      (SELECT least(CAST(floor((v - lo) / (hi - lo) * 40) AS BIGINT), 39) AS k, count(*) AS n, any_value(lo) AS lo,
       any_value(hi) AS hi, any_value(total) AS total, any_value(h) AS h
       FROM (SELECT {CLIPPED} AS v FROM trips), (SELECT min({CLIPPED}) AS lo, max({CLIPPED}) AS hi, count(*) AS total,
             stddev_samp({CLIPPED}) * pow(count(*), -0.2) AS h FROM trips) GROUP BY 1))
    GROUP BY p, lo, hi""",
    ("trips",),
)
def delay_density(spark, folder):
    return profiles.delay_density(clipped_trips(spark, folder), "delay_minutes_clipped")


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", least(CAST(floor((CAST({c} AS DOUBLE) - lo) / (hi - lo) * 30) AS BIGINT), 29) AS bin,
        count(*) AS n FROM weathered, (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM weathered)
        WHERE {c} IS NOT NULL GROUP BY 1, 2"""
        for c in S.HISTOGRAM_COLUMNS
    ),
    ("weathered",),
)
def feature_histograms(spark, folder):
    return profiles.feature_histograms(weathered(spark, folder), S.HISTOGRAM_COLUMNS)


@query(
    f"""SELECT is_delayed, bin, n, round(n * 100.0 / CAST(sum(n) OVER (PARTITION BY is_delayed) AS DOUBLE), 6) AS percent FROM
    (SELECT {LATE} AS is_delayed, least(CAST(floor((delay_minutes - lo) / (hi - lo) * 60) AS BIGINT), 59) AS bin, count(*) AS n
     FROM trips, (SELECT min(delay_minutes) AS lo, max(delay_minutes) AS hi FROM trips) GROUP BY 1, 2)""",
    ("trips",),
)
def class_histogram(spark, folder):
    return profiles.class_histogram(labelled_trips(spark, folder), "delay_minutes", "is_delayed")


# ---- evaluation of scores --------------------------------------------------


@query(
    """SELECT round(avg(CASE WHEN y_true = y_pred THEN 1 ELSE 0 END), 6) AS accuracy, count(*) AS support,
    round(avg(y_true), 6) AS positive_rate, round(avg(pow(y_proba - y_true, 2)), 6) AS brier_score FROM scored""",
    ("scored",),
)
def overall_metrics(spark, folder):
    return metrics.overall(D.scored_trips(spark, folder))


@query(
    """SELECT CAST(0 AS BIGINT) AS y_true, tn AS predicted_0, fp AS predicted_1 FROM cells
    UNION ALL SELECT CAST(1 AS BIGINT), fn, tp FROM cells""",
    ("cells",),
)
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(D.scored_trips(spark, folder))


@query(
    """, r AS (SELECT *, tn + fp AS s0, fn + tp AS s1, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, 2 * tn / (2 * tn + fp + fn) AS f0,
      tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, 2 * tp / (2 * tp + fp + fn) AS f1, (tn + tp) / (tn + fp + fn + tp) AS acc FROM cells)
    SELECT '0' AS row, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1_score, s0 AS support FROM r
    UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), s1 FROM r
    UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), s0 + s1 FROM r
    UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), s0 + s1 FROM r
    UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / (s0 + s1), 6), round((r0 * s0 + r1 * s1) / (s0 + s1), 6),
      round((f0 * s0 + f1 * s1) / (s0 + s1), 6), s0 + s1 FROM r""",
    ("cells",),
)
def classification_report(spark, folder):
    return metrics.classification_report(D.scored_trips(spark, folder))


@query(
    """SELECT round(sum(neg * (tp - pos / 2.0) / p / n), 6) AS roc_auc,
    round(sum(CAST(pos AS DOUBLE) / p * tp / (tp + fp)), 6) AS average_precision FROM curve""",
    ("curve",),
)
def ranking_scores(spark, folder):
    return metrics.ranking_scores(D.scored_trips(spark, folder))


@query(
    """SELECT round(threshold, 6) AS threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM curve
    UNION ALL SELECT CAST('inf' AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)""",
    ("curve",),
)
def roc_curve(spark, folder):
    return metrics.roc_curve(D.scored_trips(spark, folder))


@query(
    """SELECT round(threshold, 6) AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / p, 6) AS recall FROM curve
    UNION ALL SELECT NULL, CAST(1 AS DOUBLE), CAST(0 AS DOUBLE)""",
    ("curve",),
)
def precision_recall_curve(spark, folder):
    return metrics.precision_recall_curve(D.scored_trips(spark, folder))


@query(
    f"""SELECT CAST(b AS BIGINT) AS bin, round(avg(y_proba), 6) AS mean_predicted, round(avg(y_true), 6) AS observed_rate,
    count(*) AS n FROM (SELECT *, {right_closed("y_proba", [i * 0.1 for i in range(10)] + [1.0])} AS b FROM scored) GROUP BY 1""",
    ("scored",),
)
def calibration(spark, folder):
    return metrics.calibration(D.scored_trips(spark, folder))


SLICE = """SELECT {key}, count(*) AS support, round(avg(y_true), 6) AS positive_rate,
    round(avg(y_pred), 6) AS predicted_positive, round(avg(y_proba), 6) AS avg_proba FROM scored GROUP BY 1"""


@query(SLICE.format(key="hour"), ("scored",))
def slice_rates_hour(spark, folder):
    return metrics.slice_rates(D.scored_trips(spark, folder), "hour")


@query(SLICE.format(key="round(precip_mm, 6) AS precip_mm"), ("scored",))
def slice_rates_rain(spark, folder):
    return metrics.slice_rates(D.scored_trips(spark, folder), "precip_mm")


def slice_sql(column: str, edges) -> str:
    return f"""SELECT bucket, support, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
    round(positive_rate, 6) AS positive_rate FROM (SELECT CAST({right_closed(column, edges)} AS BIGINT) AS bucket,
    count(*) AS support, count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp, count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp,
    count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn, avg(y_true) AS positive_rate FROM scored GROUP BY 1)
    WHERE bucket IS NOT NULL AND tp + fp > 0 AND tp + fn > 0"""


@query(slice_sql("hour", S.HOUR_SLICE_EDGES), ("scored",))
def slice_precision_recall_hour(spark, folder):
    return metrics.slice_precision_recall(D.scored_trips(spark, folder), "hour", S.HOUR_SLICE_EDGES)


@query(slice_sql("precip_mm", S.RAIN_SLICE_EDGES), ("scored",))
def slice_precision_recall_rain(spark, folder):
    return metrics.slice_precision_recall(D.scored_trips(spark, folder), "precip_mm", S.RAIN_SLICE_EDGES)
