"""Plans that have to stay as they are at scale."""

import pytest
from pyspark.sql import functions as F

from wattline.operators.consumption import consumption, daily_usage
from wattline.operators.nearest import nearest_location
from wattline.operators.periods import attach_periods
from wattline.operators.quality import meter_quality
from wattline.operators.staging import exclude_dates, stage_readings
from wattline.sources.scratch import written


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def clean(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    return written(
        events.select(
            F.col("user_id").cast("string").alias("METER_ID"),
            F.col("ts").alias("DATA_TIME"),
            F.col("value").alias("IMPORT_ACTIVE_POWER"),
            F.col("props").alias("STATUS"),
        ),
        "clean",
    )


@pytest.fixture(scope="module")
def places(spark):
    sites = spark.range(50).select(
        F.col("id").cast("string").alias("meter_id"),
        F.lit(2.0).alias("multiplication_factor"),
        F.lit(24.0).alias("lat"),
        F.col("id").cast("double").alias("lon"),
        F.lit("Central").alias("region"),
        F.lit("AR RIYADH").alias("province"),
    )
    schedule = spark.range(30).select(
        F.lit("(24.0, 46.0)").alias("original_coordinate"),
        F.lit(24.0).alias("lat"),
        F.lit(46.0).alias("lon"),
        F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
        *[F.lit(s).alias(n) for n, s in [("fajr_time", 16800), ("dhuhr_time", 43200), ("isha_time", 70200)]],
    )
    return written(sites, "sites"), written(schedule, "schedule")


def test_staging_reads_three_columns_and_shuffles_once(clean):
    text = plan(stage_readings(clean))
    assert text.count("ReadSchema: struct<METER_ID:string,DATA_TIME:timestamp_ntz,IMPORT_ACTIVE_POWER:double>") == 2
    assert text.count("Exchange hashpartitioning") == 1
    assert "PushedFilters: [IsNotNull(METER_ID), IsNotNull(DATA_TIME)]" in text
    # rows without key: row groups without nulls are skipped
    assert "Or(IsNull(METER_ID),IsNull(DATA_TIME))" in text


def test_consumption_shuffles_readings_once(clean, places):
    sites, schedule = places
    located = written(nearest_location(sites, schedule), "located")
    text = plan(consumption(attach_periods(stage_readings(clean), located, schedule), located))
    totals = text.split("Exchange hashpartitioning(meter_id", 1)[1]
    assert "SortMergeJoin" not in totals and totals.count("BroadcastHashJoin") == 2
    # deduplication, then only partial sums per meter
    assert text.count("Exchange hashpartitioning(meter_id") == 2 and "partial_sum" in totals


@pytest.mark.parametrize("inline", [0, 2000])
def test_nearest_has_no_cross_join(places, inline):
    text = plan(nearest_location(*places, max_inline_locations=inline))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_salted_join_spreads_a_meter(clean, places):
    sites, schedule = places
    located = written(nearest_location(sites, schedule), "located")
    text = plan(attach_periods(stage_readings(clean), located, schedule, max_broadcast_bytes=0))
    assert "BroadcastHashJoin" not in text
    joined = [line for line in text.splitlines() if "SortMergeJoin" in line]
    assert len(joined) == 2 and all("_salt" in line for line in joined)


def test_only_a_small_right_side_is_broadcast(clean):
    from wattline.operators.joins import join_per_key, row_bytes

    right = clean.groupBy("METER_ID").agg(F.max("IMPORT_ACTIVE_POWER").alias("most"))
    assert row_bytes(right) == 112
    small = plan(join_per_key(clean, right, ["METER_ID"], "left", F.col("DATA_TIME"), rows=10))
    large = plan(join_per_key(clean, right, ["METER_ID"], "left", F.col("DATA_TIME"), rows=10_000_000))
    assert "BroadcastHashJoin" in small and "BroadcastHashJoin" not in large


@pytest.mark.parametrize("model", [meter_quality, daily_usage])
def test_large_groupings_use_hash_aggregation(clean, model):
    staged = written(stage_readings(clean), "staged")
    text = plan(model(staged))
    assert "HashAggregate" in text and "SortAggregate" not in text and "partial_" in text


def test_exclusion_reaches_the_scan(clean):
    from datetime import date

    staged = written(stage_readings(clean), "staged")
    text = plan(exclude_dates(staged, (date(2024, 1, 2), date(2024, 1, 3))))
    assert "PushedFilters: [" in text and "LessThan(reading_date" in text and "GreaterThan(reading_date" in text
