import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway import schema as S
from headway.operators import metrics, models
from headway.sources import arrivals, processed, sinks
from headway.streaming import score as streaming
from tests_data import write

ARRIVALS = "service_date,scheduled,actual,route_id,direction_id,stop_id,time_point_order,point_type\n"


def test_listing_and_union_by_name(spark, tmp_path):
    one, two = tmp_path / "y1", tmp_path / "y2"
    write(one / "b.csv", ARRIVALS + "2023-01-01,2023-01-01 08:00:00,2023-01-01 08:05:00,01,0,S1,1,A\n")
    write(one / "a.csv", ARRIVALS + "2023-01-01,2023-01-01 08:00:00,2023-01-01 08:05:00,01,0,S1,1,A\n")
    write(one / "c.txt", "not a table\n")
    write(two / "a.csv", "stop_id,service_date,route_id,time_point_order,extra\n007,2024-01-01,1,x,e\n")
    assert [p.rsplit("/", 1)[1] for p in arrivals.list_csv(spark, str(one))] == ["a.csv", "b.csv"]
    df = arrivals.read_arrivals(spark, str(one), str(two))
    assert df.count() == 3 and "extra" in df.columns
    row = df.where("stop_id = '007'").first()
    assert row["route_id"] == "1" and row["time_point_order"] is None and row["point_type"] is None
    empty = tmp_path / "none"
    empty.mkdir()
    with pytest.raises(FileNotFoundError):
        arrivals.read_arrivals(spark, str(empty))


def test_files_of_a_folder_are_matched_by_name(spark, tmp_path):
    write(tmp_path / "d" / "a.csv", "stop_id,route_id\n1,2\n")
    write(tmp_path / "d" / "b.csv", "route_id,stop_id,extra\n2,1,e\n")
    write(tmp_path / "d" / "c.csv", "stop_id,route_id\n1,2\n")
    rows = arrivals.read_csv(spark, str(tmp_path / "d"), {}).collect()
    assert sorted((r["stop_id"], r["route_id"], r["extra"] or "") for r in rows) == [("1", "2", ""), ("1", "2", ""), ("1", "2", "e")]


def test_whole_numbers_may_look_like_decimals(spark, tmp_path):
    write(tmp_path / "n.csv", "hour,weekday,temp\n8.0, 3 ,1\n8.5,x,1e1\n,7,\n")
    types = {"hour": T.IntegerType(), "weekday": T.IntegerType(), "temp": T.DoubleType()}
    rows = arrivals.read_csv(spark, str(tmp_path / "n.csv"), types).collect()
    assert [tuple(r) for r in rows] == [(8, 3, 1.0), (None, None, 10.0), (None, 7, None)]
    lost = arrivals.unreadable(arrivals.read_text(spark, str(tmp_path / "n.csv")), types)
    assert {r["column"]: r["n_unreadable"] for r in lost.collect()} == {"hour": 1, "weekday": 1, "temp": 0}


def test_weather_years(spark, tmp_path):
    head = "year,month,day,hour,temp,rhum,prcp,wdir,wspd,pres,cldc,coco,wpgt,temp_source\n"
    write(tmp_path / "w1.csv", head + "2023,1,1,0,1.0,50,0.0,180,3.0,1010,0.1,1,5.0,x\n")
    write(tmp_path / "w2.csv", head + "2024,1,1,0,2.0,50,0.0,180,3.0,1010,0.1,3,5.0,x\n")
    df = arrivals.read_conditions(spark, str(tmp_path / "w1.csv"), str(tmp_path / "w2.csv"))
    assert df.count() == 2 and dict(df.dtypes)["temp"] == "double"


INTEGRATED = (
    "service_date,hour,weekday,is_weekend,route_id,direction_id,stop_id,time_point_order,point_type,scheduled_dt,"
    "actual_dt,delay_seconds,delay_minutes,event_hour,air_temp_c,rel_humidity_pct,precip_mm,wind_dir_deg,"
    "wind_speed_kmh,pressure_hpa,cloud_cover,weather_condition\n"
)


def integrated(tmp_path, delays):
    lines = [
        f"2023-0{1 + i % 2}-02,8,0,0,01,0,005,1,A,2023-01-02 08:00:00,2023-01-02 08:05:00,{d},5.0,2023-01-02 08:00:00,"
        "1.0,50,0.3,180,3.0,1010,0.1,Clear\n"
        for i, d in enumerate(delays)
    ]
    write(tmp_path / "in.csv", INTEGRATED + "".join(lines))
    return str(tmp_path / "in.csv")


def test_processed_cache_is_reused_and_rebuilt(spark, tmp_path):
    source, cache = integrated(tmp_path, [300.0, 301.0, 9000.0, ""]), str(tmp_path / "cache")
    df = processed.load_or_build(spark, source, cache, clipped_delay=True)
    assert df.count() == 2
    row = df.where("delay_seconds = 301").first()
    assert (row["label"], row["label_mc"], row["route_id"], row["stop_id"]) == (1, "delayed", "01", "005")
    assert row["rainy_rush_hour"] == 1.0 and row["service_month"] == "2023-02"
    assert row["service_date"] == dt.date(2023, 2, 2)
    assert set(S.PROCESSED_NUMERIC) <= {n for n, t in df.dtypes if t == "float"}
    written = {p.name for p in (tmp_path / "cache").rglob("*.parquet")}
    processed.load_or_build(spark, source, cache, clipped_delay=True)
    assert {p.name for p in (tmp_path / "cache").rglob("*.parquet")} == written
    assert "delay_sec_clipped" not in processed.load_or_build(spark, source, cache).columns
    assert processed.load_or_build(spark, source, cache, rebuild=True).count() == 2
    assert {p.name for p in (tmp_path / "cache").rglob("*.parquet")} != written


def arrival_file(folder, name, dates):
    lines = [
        f"{d},8,0,0,01,0,005,1,A,2023-01-02 08:00:00,2023-01-02 08:05:00,{300 + i},5.0,2023-01-02 08:00:00,"
        "1.0,50,0.3,180,3.0,1010,0.1,Clear\n"
        for i, d in enumerate(dates)
    ]
    folder.mkdir(exist_ok=True)
    write(folder / name, INTEGRATED + "".join(lines))


def test_a_file_costs_its_own_months_only(spark, tmp_path):
    source, cache = tmp_path / "in", tmp_path / "cache"

    def load():
        df = processed.load_or_build(spark, str(source), str(cache))
        found = {r["service_month"]: r["count"] for r in df.groupBy("service_month").count().collect()}
        parts = {p.parent.name.split("=")[1]: p.name for p in cache.rglob("service_month=*/*.parquet")}
        fresh = processed.load_or_build(spark, str(source), str(tmp_path / "anew"), rebuild=True)
        assert sorted(map(str, df.collect())) == sorted(map(str, fresh.collect()))
        return found, parts

    arrival_file(source, "jan.csv", ["2023-01-05", "2023-01-06"])
    arrival_file(source, "feb and mar.csv", ["2023-02-05", "2023-03-01"])
    found, first = load()
    assert found == {"2023-01": 2, "2023-02": 1, "2023-03": 1}

    arrival_file(source, "late.csv", ["2023-02-07", "2023-04-01", "2023-04-02"])  # a new file
    found, second = load()
    assert found == {"2023-01": 2, "2023-02": 2, "2023-03": 1, "2023-04": 2}
    assert {m for m in first if second[m] != first[m]} == {"2023-02"}

    arrival_file(source, "jan.csv", ["2023-01-05", "2023-01-06", "2023-04-09"])  # a changed one
    found, third = load()
    assert found["2023-04"] == 3 and {m for m in second if third[m] != second[m]} == {"2023-01", "2023-04"}

    (source / "feb and mar.csv").unlink()  # a lost one, which alone had March
    found, last = load()
    assert found == {"2023-01": 2, "2023-02": 1, "2023-04": 3}
    assert {m for m in last if third[m] != last[m]} == {"2023-02"}
    assert load()[1] == last

    arrival_file(source, "none.csv", [])  # a file without rows is known, too
    assert load()[1] == last
    known = processed.manifest(spark, str(cache)).groupBy("name").agg(F.sum("n").alias("n")).collect()
    assert sorted(r["n"] for r in known) == [0, 3, 3]


def test_month_partitions_are_pruned(spark, tmp_path):
    from headway.operators.splits import dated_splits

    source, cache = integrated(tmp_path, [1.0, 2.0]), str(tmp_path / "cache")
    df = dated_splits(processed.load_or_build(spark, source, cache), ("2023-02-01", "2023-02-02", "2023-02-03", "2023-03-01"))
    assert len(df.collect()) == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "service_month" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_sample_cache(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    for _ in range(2):
        assert processed.load_or_build_sample(spark, build, str(tmp_path / "s")).count() == 5
    assert len(calls) == 1


def test_csv_json_and_text_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("01", 1.5), ("2", None)], "route_id string, x double")
    sinks.save_csv(df, str(tmp_path / "deep" / "csv"))
    back = spark.read.schema(df.schema).option("header", True).csv(str(tmp_path / "deep" / "csv"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))

    scored = spark.createDataFrame([(1, 1, 0.9), (0, 0, 0.2), (0, 1, 0.7)], "y_true int, y_pred int, y_proba double")
    sinks.save_json(metrics.evaluation(scored), str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).first()["support"] == 3

    report = sinks.report_text(scored, metrics.ranking_scores(scored), "TEST")
    sinks.save_text(sinks.summary_text(report, {"Test ROC-AUC": 0.5}), str(tmp_path / "txt"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "txt")).collect()]
    assert lines[0] == "=== TEST ===" and "not_delayed" in lines[2] and lines[-1] == "Test ROC-AUC: 0.5"
    assert "ROC-AUC: 1.0000" in lines


def test_new_files_are_scored_once(spark, tmp_path):
    from test_models import bus_rows

    df = bus_rows(spark)
    model = models.FittedModel(models.fit_gradient_descent(df, maxIter=1), S.LINEAR_NUMERIC + S.LINEAR_CATEGORICAL)
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for batch in range(2):
        df.withColumn("hour", F.lit(float(batch))).coalesce(1).write.mode("append").option("header", True).csv(inbox)
        rows = streaming.read_new_files(spark, inbox, df.schema)
        streaming.score_new_files(model, rows, out, state).awaitTermination()
        assert spark.read.parquet(out).count() == 32 * (batch + 1)
