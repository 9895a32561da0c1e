import math
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattline.functions import (
    add_minutes,
    canonical_id,
    clock_text_to_seconds,
    half_up,
    haversine_metres,
    latlon_text,
    parse_reading_time,
    quarter_label,
    row_hash,
    safe_double,
    second_of_day,
    time_text,
)


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_reading_time_shapes(spark):
    texts = [
        "2025-08-02 00:30:00",
        "2025-08-02 00:30:59.4600000",
        "2025-08-02",
        "2025-02-30 00:00:00",
        "02/08/2025 00:30",
        "2025-08-02T00:30:00",
        "",
        None,
    ]
    got = values(spark, [(t,) for t in texts], "t string", parse_reading_time(F.col("t")))
    half_past = datetime(2025, 8, 2, 0, 30)
    assert got == [half_past, half_past, datetime(2025, 8, 2), None, None, None, None, None]


def test_reading_time_ignores_session_zone(spark):
    """02:30 does not exist in this zone on that day."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-03-10 02:30:45",)], "t string")
        row = df.select(time_text(parse_reading_time(F.col("t"))), second_of_day(parse_reading_time(F.col("t")))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == ("2024-03-10 02:30:00", 2 * 3600 + 30 * 60)


def test_half_up(spark):
    got = values(
        spark,
        [(2.675,), (1.0005,), (-1.0005,), (0.0,), (None,), (math.nan,), (1e17,)],
        "x double",
        half_up(F.col("x"), 3),
    )
    assert got[:5] == [2.675, 1.001, -1.001, 0.0, None]
    assert math.isnan(got[5]) and got[6] == 1e17
    ties = [(2.675,), (1.005,), (0.285,), (-1.005,), (0.125,), (1.0049,)]
    assert values(spark, ties, "x double", half_up(F.col("x"), 2)) == [2.68, 1.01, 0.29, -1.01, 0.13, 1.0]
    assert values(spark, [(32.0425,)], "x double", half_up(F.col("x"), 3)) == [32.043]


def test_ids(spark):
    got = values(spark, [("007",), (" 12 ",), ("000",), ("0a1",), (None,), ("A07",)], "x string", canonical_id(F.col("x")))
    assert got == ["7", "12", "0", "0a1", None, "A07"]


def test_safe_double(spark):
    got = values(spark, [(" 1.5 ",), ("x",), ("",), (None,), ("1e3",)], "x string", safe_double(F.col("x")))
    assert got == [1.5, None, None, None, 1000.0]


def test_row_hash_of_missing_parts_is_constant(spark):
    rows = [("1", None), (None, "2024-01-01 00:00:00"), (None, None), ("1", "2024-01-01 00:00:00")]
    got = values(spark, rows, "m string, t string", row_hash(F.col("m"), F.col("t")))
    assert got[0] == got[1] == got[2] != got[3]
    assert all(0 <= h < 2**63 - 1 for h in got)


@settings(max_examples=20, deadline=None)
@given(seconds=st.lists(st.integers(0, 86399), min_size=1, max_size=20), minutes=st.integers(-2000, 2000))
def test_add_minutes_wraps(spark, seconds, minutes):
    got = values(spark, [(s,) for s in seconds], "s int", add_minutes(F.col("s"), minutes))
    assert got == [(s + 60 * minutes) % 86400 for s in seconds]


def test_clock_text(spark):
    assert values(spark, [("00:00",), ("23:59",), ("7:05",), (None,)], "t string", clock_text_to_seconds(F.col("t"))) == [
        0,
        86340,
        25500,
        None,
    ]
    for bad in ("24:00", "12:60", "noon"):
        with pytest.raises(Exception, match="HH:MM"):
            values(spark, [(bad,)], "t string", clock_text_to_seconds(F.col("t")))


def test_coordinates(spark):
    lat, lon = latlon_text(F.col("t"))
    df = spark.createDataFrame([("(24.7136, 46.6753)",)], "t string")
    assert tuple(df.select(lat, lon).first()) == (24.7136, 46.6753)
    with pytest.raises(Exception):
        spark.createDataFrame([("(here, there)",)], "t string").select(lat).collect()


def test_distance(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (0.0, 0.0, 0.0, 90.0), (1.0, 1.0, 1.0, 1.0), (None, 0.0, 1.0, 1.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_metres(F.col("a"), F.col("b"), F.col("c"), F.col("d"), 1.0)).collect()]
    assert got[0] == pytest.approx(math.pi) and got[1] == pytest.approx(math.pi / 2) and got[2] == 0.0 and got[3] is None


def test_quarter(spark):
    got = values(spark, [(datetime(2024, 3, 31),), (datetime(2024, 4, 1),), (None,)], "t timestamp_ntz", quarter_label(F.col("t")))
    assert got == ["2024-Q1", "2024-Q2", None]
