from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wattline.operators.staging import exclude_dates, keep_first, stage_readings, stage_schedule, stage_sites

CLEAN = "METER_ID string, DATA_TIME timestamp_ntz, IMPORT_ACTIVE_POWER double"
T0 = datetime(2024, 1, 1, 0, 30)


def stage(spark, rows):
    return stage_readings(spark.createDataFrame(rows, CLEAN))


def test_outlier_bounds(spark):
    watts = [1e9, 1e9 + 1, 0.0, -0.001, None, 1.0005]
    rows = [(str(i), T0, w) for i, w in enumerate(watts)]
    got = {r.meter_id: r.active_power_watts for r in stage(spark, rows).collect()}
    assert [got[str(i)] for i in range(6)] == [1e9, None, 0.0, None, None, 1.001]


def test_highest_power_wins_nulls_last(spark):
    rows = [("a", T0, None), ("a", T0, 5.0), ("a", T0, 7.0), ("b", T0, None), ("b", T0, None), ("c", T0, 2e9), ("c", T0, 3.0)]
    got = {r.meter_id: r.active_power_watts for r in stage(spark, rows).collect()}
    # the winner is chosen among the copies inside the bounds
    assert got == {"a": 7.0, "b": None, "c": 3.0}


def test_rows_without_key_leave_one_row(spark):
    rows = [("a", None, 1.0), ("b", None, 9.0), (None, T0, 3.0), ("a", T0, 4.0)]
    got = stage(spark, rows).orderBy("meter_id").collect()
    assert [(r.meter_id, r.reading_at, r.active_power_watts) for r in got] == [("a", T0, 4.0), ("b", None, 9.0)]
    assert got[1].reading_date is None and got[1].quarter is None and got[1].reading_time is None


def test_staging_equals_window_form(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    clean = events.select(
        F.col("user_id").cast("string").alias("METER_ID"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("DATA_TIME"),
        F.col("value").alias("IMPORT_ACTIVE_POWER"),
    )
    first = keep_first(clean, ["METER_ID", "DATA_TIME"], [F.col("IMPORT_ACTIVE_POWER").desc_nulls_last()])
    columns = ["meter_id", "reading_at", "active_power_watts"]
    assert stage_readings(first).select(columns).exceptAll(stage_readings(clean).select(columns)).isEmpty()
    assert stage_readings(clean).count() == first.count() < clean.count()


def test_staging_is_idempotent(spark):
    once = stage(spark, [("a", T0, 5.0), ("a", T0, 7.0), ("b", T0, -3.0)])
    again = stage_readings(once.select(F.col("meter_id").alias("METER_ID"), F.col("reading_at").alias("DATA_TIME"), F.col("active_power_watts").alias("IMPORT_ACTIVE_POWER")))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))


def test_staging_has_no_sort(spark):
    plan = stage(spark, [("a", T0, 5.0)])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate(key=[meter_id" not in plan and "Window" not in plan


def test_keep_first_groups_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (5, 3)], "k int, v int")
    assert sorted(r.v for r in keep_first(df, ["k"], [F.col("v").desc()]).collect()) == [2, 3]


@pytest.mark.parametrize(
    "bounds, left",
    [
        (None, 5),
        ((date(2024, 1, 2), None), 5),
        ((None, date(2024, 1, 2)), 5),
        ((date(2024, 1, 2), date(2024, 1, 3)), 2),
    ],
)
def test_exclusion(spark, bounds, left):
    days = [date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3), date(2024, 1, 4), None]
    df = spark.createDataFrame([(d,) for d in days], "reading_date date")
    assert exclude_dates(df, bounds).count() == left


SITE = "`Meter Number` string, `Multiplication Factor` string, `X Coordinates` string, `Y Coordinates` string, Region string, Province string, `Department Name` string, `Office Name` string"


def test_sites(spark):
    rows = [
        ("0071", "#", "46.5", "24.5"),
        ("72", " 60 ", "n/a", "24.5"),
        ("73", "many", "46.5", None),
        ("74", None, "46.5", "24.5"),
    ]
    df = spark.createDataFrame([(*r, "Central", "RIYADH 1", "d", "o") for r in rows], SITE)
    got = {r.meter_id: (r.multiplication_factor, r.lat, r.lon) for r in stage_sites(df).collect()}
    assert got == {"71": (1.0, 24.5, 46.5), "72": (60.0, None, None), "73": (1.0, None, None), "74": (1.0, 24.5, 46.5)}


def schedule(spark, date_text="29-02-2024", fajr="04:40"):
    row = ("(24.7136, 46.6753)", date_text, fajr, "12:00", "15:30", "18:05", "19:30")
    return stage_schedule(spark.createDataFrame([row], "Coordinate string, Date string, Fajr string, Dhuhr string, Asr string, Maghrib string, Isha string"))


def test_schedule(spark):
    row = schedule(spark).first()
    assert (row.lat, row.lon, row.date) == (24.7136, 46.6753, date(2024, 2, 29))
    assert (row.fajr_time, row.dhuhr_time, row.asr_time, row.maghrib_time, row.isha_time) == (16800, 43200, 55800, 65100, 70200)


@pytest.mark.parametrize("bad", [{"date_text": "30-02-2024"}, {"date_text": "2024-02-01"}, {"fajr": "4.40"}])
def test_schedule_is_strict(spark, bad):
    with pytest.raises(Exception):
        schedule(spark, **bad).collect()
