import datetime as dt

import pytest
from pyspark.sql import functions as F

from headway import schema as S
from headway.functions import calendar, labels, numeric, text, time
from headway.operators import cleaning, features

RAW = "service_date string, scheduled string, actual string, route_id string, direction_id string, stop_id string, time_point_order int, point_type string"


def raw(spark, *rows):
    return spark.createDataFrame(rows, RAW)


FIVE_LATE = ("2023-01-01", "2023-01-01 17:12:30", "2023-01-01 17:17:30", "1", "0", "S1", 1, "A")
TEN_EARLY = ("2023-01-01", "2023-01-01 06:10:00", "2023-01-01 06:00:00", "1", "1", "S2", 2, "B")


def test_distinct_treats_nulls_as_equal(spark):
    row = ("2023-01-01", None, None, "1", "0", None, 1, "A")
    df = raw(spark, row, row, FIVE_LATE, FIVE_LATE)
    assert cleaning.distinct_rows(df).count() == 2


def test_clean_arrivals_columns_and_delay(spark):
    out = cleaning.clean_arrivals(raw(spark, FIVE_LATE, TEN_EARLY, FIVE_LATE))
    assert out.columns == S.CLEAN_ARRIVAL_COLUMNS
    rows = {r["stop_id"]: r for r in out.collect()}
    assert len(rows) == 2
    late, early = rows["S1"], rows["S2"]
    assert (late["delay_seconds"], late["delay_minutes"]) == (300.0, 5.0)
    assert early["delay_seconds"] == -600.0
    # a Sunday
    assert (late["hour"], late["weekday"], late["is_weekend"]) == (17, 6, 1)


def test_only_the_time_of_day_counts(spark):
    after_midnight = ("2023-01-01", "2023-01-01 23:50:00", "2023-01-02 00:10:00", "1", "0", "S", 1, "A")
    unreadable = ("2023-01-01", "n/a", "2023-01-01 10:00:00", "1", "0", "T", 1, "A")
    no_date = ("soon", "2023-01-01 10:00:00", "2023-01-01 10:00:00", "1", "0", "U", 1, "A")
    rows = {r["stop_id"]: r for r in cleaning.clean_arrivals(raw(spark, after_midnight, unreadable, no_date)).collect()}
    assert rows["S"]["delay_seconds"] == -(23 * 3600 + 40 * 60)
    assert rows["T"]["scheduled_dt"] is None and rows["T"]["hour"] is None and rows["T"]["is_weekend"] == 0
    assert rows["U"]["actual_dt"] is None


def test_results_do_not_depend_on_the_session_time_zone(spark):
    clock = ("2023-03-12", "2023-03-12 01:30:00", "2023-03-12 03:30:00", "1", "0", "S", 1, "A")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:00-03:00 does not exist there
        assert cleaning.clean_arrivals(raw(spark, clock)).first()["delay_seconds"] == 7200.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


WEATHER = "year int, month int, day int, hour int, temp double, temp_source string, rhum double, prcp double, wdir double, wspd double, pres double, cldc double, coco int, wpgt double"


def weather(spark):
    return spark.createDataFrame(
        [
            (2024, 6, 9, 13, 21.5, "model", 43.0, 0.4, 265.0, 17.2, 998.7, 6.0, 17, 31.0),
            (2024, 6, 9, 14, 19.0, "model", 61.0, 2.1, 270.0, 22.8, 997.9, 8.0, 25, 48.5),
            (2024, 6, 9, 15, 18.2, "site", 72.0, 0.0, 290.0, 11.3, 998.1, 7.0, 99, 20.0),
        ],
        WEATHER,
    )


def test_clean_conditions(spark):
    out = cleaning.clean_conditions(weather(spark))
    assert out.columns == ["timestamp_hour", *S.CONDITION_COLUMNS.values()]
    assert [r["weather_condition"] for r in out.orderBy("timestamp_hour").collect()] == ["Rain Shower", "Thunderstorm", None]


def test_arrival_gets_the_weather_of_its_hour(spark):
    arrivals = spark.createDataFrame(
        [(1, dt.datetime(2024, 6, 9, 13, 47)), (2, dt.datetime(2024, 6, 11, 13, 47)), (3, None)],
        "id int, actual_dt timestamp_ntz",
    )
    hourly = cleaning.clean_conditions(weather(spark))
    rows = {r["id"]: r for r in features.join_conditions(arrivals, hourly).collect()}
    assert rows[1]["event_hour"] == dt.datetime(2024, 6, 9, 13) and rows[1]["air_temp_c"] == 21.5
    assert rows[2]["air_temp_c"] is None and rows[3]["event_hour"] is None
    assert features.join_conditions(arrivals, hourly, drop_incomplete=True).count() == 1
    doubled = hourly.unionByName(hourly)
    assert features.join_conditions(arrivals, doubled).where("id = 1").count() == 2


def values(spark, kind, items):
    return spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"id int, x {kind}")


def applied(spark, kind, items, f):
    rows = values(spark, kind, items).select("id", f(F.col("x")).alias("y")).orderBy("id").collect()
    return [r["y"] for r in rows]


def test_label_edges(spark):
    got = applied(spark, "double", [-300.0, -299.0, 300.0, 300.5, None], labels.three_way_label)
    assert got == ["early", "on-time", "on-time", "delayed", None]
    got = applied(spark, "string", ["delayed", "early", None], labels.delayed_class)
    assert got == [1, 0, 0]
    assert applied(spark, "double", [5.0, 4.99], lambda c: labels.late_by(c, 5.0)) == [1, 0]


def test_valid_delay_edges(spark):
    df = values(spark, "double", [7200.0, -7200.0, 7200.1, -7200.1, None]).withColumnRenamed("x", "delay_seconds")
    assert sorted(r["id"] for r in cleaning.valid_delays(df).collect()) == [0, 1]
    assert tuple(cleaning.rejected_delays(df).first()) == (5, 2, 3)


def test_numbers(spark):
    inf = float("inf")
    assert applied(spark, "double", [1.0, inf, -inf, float("nan"), None], numeric.finite) == [1.0, None, None, None, None]
    assert applied(spark, "string", ["7", "x", "", None, "NaN"], numeric.to_number) == [7.0, None, None, None, None]
    assert applied(spark, "double", [-11.0, 31.0, 5.0, None], lambda c: numeric.clip(c, -10.0, 30.0)) == [-10.0, 30.0, 5.0, None]
    edges = [0.0, 1.0, 2.0]
    got = applied(spark, "double", [0.0, 1.0, 1.1, 2.0, 2.1, -0.1, None], lambda c: numeric.right_closed_bin(c, edges))
    assert got == [1, 1, 2, 2, None, None, None]
    got = applied(spark, "double", [0.0, 0.99, 1.0, 4.0, None], lambda c: numeric.equal_width_bin(c, 0.0, 4.0, 4))
    assert got == [0, 0, 1, 3, None]


def test_rain_and_rush_hour(spark):
    df = spark.createDataFrame(
        [(0.2, 8), (0.2001, 8), (0.2001, 9), (0.2001, 10), (None, 8), (1.0, None), (1.0, 16), (1.0, 18), (1.0, 19)],
        "rain double, hour int",
    )
    got = [r[0] for r in df.select(numeric.rainy_rush_hour(F.col("rain"), F.col("hour"))).collect()]
    assert got == [0, 1, 1, 0, 0, 0, 1, 1, 0]


def test_text(spark):
    assert applied(spark, "string", ["7", "101", "", None], text.pad_two) == ["07", "101", "00", None]
    got = applied(spark, "string", [" a ", "", " ", None, "nan", "<NA>"], text.category)
    assert got == ["a"] + ["<missing>"] * 5
    assert applied(spark, "string", [" ", "x", None], text.legacy_category) == ["Unknown", "x", "<missing>"]


def days(spark, items, f):
    return applied(spark, "date", [dt.date.fromisoformat(d) if d else None for d in items], f)


def test_seasons_and_school(spark):
    assert days(spark, ["2023-12-01", "2023-02-28", "2023-03-01", "2023-08-31", "2023-09-01", None], calendar.season) == [1, 1, 2, 3, 4, None]
    got = days(
        spark,
        ["2024-01-14", "2024-01-15", "2024-05-15", "2024-05-16", "2024-08-31", "2024-09-01", "2024-12-20", "2024-12-21", None],
        calendar.school_flag,
    )
    assert got == [0, 1, 1, 0, 0, 1, 1, 0, None]


def test_holidays(spark):
    expected = {
        "2023-01-01", "2023-01-02", "2023-01-16", "2023-02-20", "2023-05-29", "2023-06-19", "2023-07-04",
        "2023-09-04", "2023-10-09", "2023-11-10", "2023-11-11", "2023-11-23", "2023-12-25",
    }
    found = {str(r[0]) for r in calendar.holiday_table(spark, 2023, 2023).collect()}
    assert found == expected
    assert days(spark, ["2021-12-31", "2019-06-19", None], calendar.holiday_flag) == [1, 0, 0]


def test_hour_floor_and_time_parts(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 28, 23, 59, 59, 999999),)], "ts timestamp_ntz")
    row = df.select(time.floor_hour(F.col("ts")).alias("h"), time.seconds_between(time.start_of_day(F.col("ts")), F.col("ts")).alias("s")).first()
    assert row["h"] == dt.datetime(2024, 2, 28, 23) and row["s"] == pytest.approx(86399.999999)


def test_column_drop_and_completeness(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, "a", float("nan")), (3, "b", 1.0)], "id int, t string, x double")
    assert [r["id"] for r in cleaning.complete_rows(df).collect()] == [3]
    assert sorted(r["id"] for r in cleaning.complete_rows(df, ["t"]).collect()) == [2, 3]
