from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattline.operators import reports
from wattline.operators.consumption import consumption, daily_usage
from wattline.operators.periods import attach_periods, in_evening, in_morning, schedule_periods, schedule_repeats
from wattline.operators.quality import meter_quality
from wattline.operators.staging import stage_readings
from wattline.operators.violations import flag_over, regional_consumption, regional_violators, violation_category, violators
from wattline.spec import COMPARISON, QualitySpec, RegionSpec, ThresholdSpec

CLEAN = "METER_ID string, DATA_TIME timestamp_ntz, IMPORT_ACTIVE_POWER double"
SCHEDULE = "original_coordinate string, date date, fajr_time int, dhuhr_time int, isha_time int"
PLACES = "meter_id string, nearest_prayer_coordinate string, multiplication_factor double, region string, province string"
THURSDAY, FRIDAY = date(2024, 1, 4), date(2024, 1, 5)


def hm(text):
    h, m = text.split(":")
    return int(h) * 3600 + int(m) * 60


def calendar(spark, days, fajr="04:40", dhuhr="12:00", isha="19:30", place="x"):
    rows = [(place, d, hm(fajr), hm(dhuhr), hm(isha)) for d in days]
    return spark.createDataFrame(rows, SCHEDULE)


def readings(spark, rows):
    return stage_readings(spark.createDataFrame(rows, CLEAN))


def places(spark, *meters, factor=1.0, region="Central", province="AR RIYADH"):
    return spark.createDataFrame([(m, "x", factor, region, province) for m in meters], PLACES)


def test_wrap_at_midnight_both_ways(spark):
    row = schedule_periods(calendar(spark, [THURSDAY], fajr="01:00", dhuhr="01:10", isha="23:00")).first()
    assert (row.morning_start_time, row.morning_end_time) == (hm("02:40"), hm("23:50"))
    assert (row.evening_start_time, row.evening_end_time) == (hm("00:30"), hm("23:40"))


@pytest.mark.parametrize(
    "day, time, expected",
    [
        (THURSDAY, "06:20", (True, False)),  # exactly the morning start
        (THURSDAY, "06:19", (False, False)),
        (THURSDAY, "10:40", (True, False)),  # exactly the morning end
        (THURSDAY, "10:41", (False, False)),
        (THURSDAY, "21:00", (False, True)),  # exactly the evening start
        (THURSDAY, "20:59", (False, False)),
        (THURSDAY, "03:20", (False, True)),  # exactly the evening end
        (THURSDAY, "03:21", (False, False)),
        (FRIDAY, "08:00", (False, False)),  # no Friday mornings
        (FRIDAY, "22:00", (False, True)),
    ],
)
def test_period_bounds(spark, day, time, expected):
    at = datetime(day.year, day.month, day.day) + timedelta(seconds=hm(time))
    joined = attach_periods(readings(spark, [("a", at, 1.0)]), places(spark, "a"), calendar(spark, [THURSDAY, FRIDAY]))
    assert tuple(joined.select(in_morning(), in_evening()).first()) == expected


def test_wrapped_periods(spark):
    """A morning that ends before it starts matches nothing; an evening starting after midnight
    covers nearly the whole day."""
    wrapped = calendar(spark, [THURSDAY], fajr="12:00", dhuhr="12:00", isha="22:40")
    rows = [("a", datetime(2024, 1, 4, h, 15), 1.0) for h in range(24)]
    joined = attach_periods(readings(spark, rows), places(spark, "a"), wrapped)
    flags = joined.select(in_morning().alias("m"), in_evening().alias("e")).collect()
    assert not any(r.m for r in flags) and all(r.e for r in flags)


@pytest.mark.parametrize("max_bytes", [0, 100_000])
def test_calendar_join(spark, max_bytes):
    """Any year matches by month and day; 29 February needs a leap calendar; two years repeat rows."""
    rows = [("a", datetime(2024, 2, 28, 1), 1.0), ("a", datetime(2024, 2, 29, 1), 1.0), ("lost", datetime(2024, 2, 28, 1), 1.0)]
    common = calendar(spark, [date(2023, 2, 28)])
    got = attach_periods(readings(spark, rows), places(spark, "a"), common, max_broadcast_bytes=max_bytes)
    assert sorted((r.meter_id, r.reading_date.day, r.fajr_time) for r in got.collect() if r.fajr_time) == [("a", 28, 16800)]
    assert got.count() == 3
    two_years = common.unionByName(calendar(spark, [date(2022, 2, 28)]))
    assert attach_periods(readings(spark, rows), places(spark, "a"), two_years, max_broadcast_bytes=max_bytes).count() == 4
    assert [tuple(r) for r in schedule_repeats(two_years).collect()] == [("x", 2, 28, 2)] and schedule_repeats(common).isEmpty()


def test_consumption(spark):
    day = datetime(2024, 1, 4)
    rows = [
        ("a", day + timedelta(hours=8), 4000.5),
        ("a", day + timedelta(hours=9), None),
        ("a", day + timedelta(hours=12), 1000.0),
        ("a", day + timedelta(hours=22), 100.0),
        ("evening", day + timedelta(hours=23), 10.0),
        ("noon", day + timedelta(hours=12), 10.0),
        ("empty", day + timedelta(hours=8), None),
        ("quarters", datetime(2024, 6, 6, 8), 1.0),
        ("quarters", datetime(2023, 12, 7, 8), 3.0),
    ]
    known = places(spark, "a", "evening", "noon", "empty", "quarters", factor=60.0)
    days = calendar(spark, [THURSDAY, date(2023, 6, 6), date(2023, 12, 7)])
    got = {r.meter_id: r for r in consumption(attach_periods(readings(spark, rows), known, days), known).collect()}
    assert set(got) == {"a", "evening", "quarters"}  # no period data: not listed
    a = got["a"]
    assert (a.total_avg_consumption, a.total_sum_consumption, a.total_reading_count) == (1700.167, 5100.5, 3)
    assert (a.morning_avg_consumption, a.morning_sum_consumption, a.morning_reading_count) == (4000.5, 4000.5, 1)
    assert (a.evening_avg_consumption, a.evening_reading_count, a.readings_with_prayer_times) == (100.0, 1, 4)
    assert (a.total_energy_kwh, a.morning_energy_kwh, a.total_cost_sar) == (153.015, 120.015, 48.965)
    assert a.data_quality_flag == "COMPLETE" and got["evening"].data_quality_flag == "NO_MORNING_DATA"
    assert got["evening"].morning_avg_consumption is None and got["evening"].morning_reading_count == 0
    q = got["quarters"]
    assert (q.quarter, q.min_reading_date, q.max_reading_date, q.data_quality_flag) == (
        "2023-Q4",
        date(2023, 12, 7),
        date(2024, 6, 6),
        "NO_EVENING_DATA",
    )


def test_consumption_without_site(spark):
    known = places(spark, "a").withColumn("multiplication_factor", F.lit(None).cast("double"))
    one = consumption(attach_periods(readings(spark, [("a", datetime(2024, 1, 4, 8), 5.0)]), known, calendar(spark, [THURSDAY])), known).first()
    assert one.total_energy_kwh is None and one.total_sum_consumption == 5.0


def test_totals_use_hash_aggregation(spark):
    known = places(spark, "a")
    frame = consumption(attach_periods(readings(spark, [("a", datetime(2024, 1, 4, 8), 5.0)]), known, calendar(spark, [THURSDAY])), known)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate(key=[meter_id" not in plan


def test_daily_usage(spark):
    day = datetime(2024, 1, 4)
    rows = [("a", day, 1.0), ("a", day + timedelta(minutes=30), 2.0), ("a", day + timedelta(hours=1), None), ("a", day + timedelta(days=1), None)]
    got = daily_usage(readings(spark, rows)).orderBy("date").collect()
    assert tuple(got[0]) == ("a", THURSDAY, "2024-Q1", 1.5, 2.0, 1.0, 3)
    assert tuple(got[1]) == ("a", FRIDAY, "2024-Q1", None, None, None, 1)


def quality_of(spark, n_rows, zeros, days=2, per_day=4):
    start = datetime(2024, 1, 1)
    last = start + timedelta(days=days - 1)
    rows = [("a", start + timedelta(minutes=i), 0.0 if i < zeros else 5.0) for i in range(n_rows - 1)] + [("a", last, 5.0)]
    return meter_quality(readings(spark, rows), QualitySpec(per_day=per_day)).first()


def test_quality_bounds(spark):
    assert quality_of(spark, 1, 0, days=1) is None  # one day only
    half = quality_of(spark, 3, 1)
    assert (half.quality_percentage, half.is_good_quality, half.missing_readings) == (50.0, True, 1)
    over = quality_of(spark, 6, 0)
    assert (over.quality_percentage, over.missing_readings, over.date_range_days) == (150.0, -2, 1)
    # 49.996 rounds to 50.0 but is not good
    near = quality_of(spark, 1251, 1, per_day=2501)
    assert (near.quality_percentage, near.is_good_quality) == (49.98, False)


def test_quality_counts_null_power(spark):
    rows = [("a", datetime(2024, 1, 1), None), ("a", datetime(2024, 1, 2), 0.0), ("a", datetime(2024, 1, 2, 1), 1.0)]
    row = meter_quality(readings(spark, rows), QualitySpec(per_day=4)).first()
    assert (row.actual_readings, row.null_readings, row.zero_readings) == (3, 1, 1)


USAGE = (
    "meter_id string, quarter string, morning_avg_consumption double, morning_sum_consumption double, morning_reading_count long, "
    "evening_avg_consumption double, evening_sum_consumption double, evening_reading_count long, morning_energy_kwh double, "
    "evening_energy_kwh double, total_energy_kwh double, morning_cost_sar double, evening_cost_sar double, total_cost_sar double, "
    "multiplication_factor double, region string, province string, min_reading_date date, max_reading_date date"
)
QUALITY = "meter_id string, quality_percentage double, actual_readings long, zero_readings long, missing_readings long, is_good_quality boolean"


def usage(spark, *rows):
    """rows: (meter, morning average, evening average, factor, region, province)"""
    full = [
        (m, "2024-Q1", mo, 1.0, 10, ev, 1.0, 20, 1e6, 2e6, 3e6, 3e5, 6e5, 9e5, f, region, province, THURSDAY, FRIDAY)
        for m, mo, ev, f, region, province in rows
    ]
    return spark.createDataFrame(full, USAGE)


def all_good(spark, used):
    return used.select("meter_id", F.lit(90.0).alias("quality_percentage"), F.lit(1).cast("long").alias("actual_readings"), F.lit(0).cast("long").alias("zero_readings"), F.lit(0).cast("long").alias("missing_readings"), (F.col("meter_id") != "bad").alias("is_good_quality"))


def sample(spark):
    return usage(
        spark,
        ("both", 50.1, 60.0, 60.0, "Central", "AR RIYADH"),
        ("exact", 50.0, 50.0, 60.0, "Central", "AR RIYADH"),
        ("morning", 4000.0, None, 1.0, "Central", "RIYADH EAST"),
        ("evening", 1.0, 4000.0, 1.0, "Western", "MAKKAH"),
        ("unknown", 9000.0, 9000.0, None, "Central", "AR RIYADH"),
        ("bad", 9000.0, 9000.0, 1.0, "Central", "AR RIYADH"),
        ("lower", 9000.0, 9000.0, 1.0, "Central", "ar riyadh"),
    )


def test_flags(spark):
    flagged = flag_over(sample(spark)).withColumn("c", violation_category())
    got = {r.meter_id: (r.over_in_morning, r.over_in_evening, r.over_in_both, r.over_in_either, r.c) for r in flagged.collect()}
    assert got["both"] == (True, True, True, True, "BOTH_PERIODS")
    assert got["exact"] == (False, False, False, False, "COMPLIANT")  # 3000 is not over
    assert got["morning"] == (True, False, False, True, "MORNING_ONLY")
    assert got["evening"] == (False, True, False, True, "EVENING_ONLY")
    assert got["unknown"] == (False, False, False, False, "COMPLIANT")
    for m, e, both, either, _ in got.values():
        assert both == (m and e) and either == (m or e)


def test_violators(spark):
    used = sample(spark)
    got = {r.meter_id: r for r in violators(used, all_good(spark, used)).collect()}
    assert set(got) == {"both", "morning", "evening", "lower"}
    assert len(violators(used, all_good(spark, used)).columns) == 33
    assert got["morning"].potential_savings_morning_sar == 5.6  # (4000 - 500) * 10 / 2 / 1000 * 0.32
    assert got["morning"].potential_savings_evening_sar == 0.0
    assert got["both"].total_potential_savings_sar == pytest.approx(4.010 + 9.92)
    none = violators(used, all_good(spark, used), ThresholdSpec(limit_watts=1e9))
    assert none.isEmpty()


def test_region(spark):
    used = sample(spark)
    regional = regional_consumption(used, all_good(spark, used))
    assert {r.meter_id for r in regional.collect()} == {"both", "exact", "morning", "unknown"}
    assert len(regional.columns) == 30
    over = regional_violators(regional).collect()
    assert {r.meter_id for r in over} == {"both", "morning"}
    for r in over:
        assert (r.total_overs_morning, r.total_overs_evening, r.total_overs_both, r.total_overs_either, r.total_violators_riyadh) == (2, 1, 1, 2, 2)
    assert "SinglePartition" not in regional_violators(regional)._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]


def test_report(spark):
    used = sample(spark)
    scores = all_good(spark, used)
    regional = regional_consumption(used, scores)
    row = reports.regional_report(regional, scores, used).first()
    assert (row.total_meters_before_quality_filter, row.total_meters_after_quality_filter) == (5, 4)
    assert (row.overs_morning, row.overs_evening, row.overs_both, row.overs_either) == (2, 1, 1, 2)
    # flagged: two mornings of 1 GWh, one evening of 2 GWh; unflagged: two mornings, three evenings
    assert (row.over_consumers_gwh, row.regular_consumers_gwh) == (4.0, 8.0)
    assert {k: row[k] for k in COMPARISON} == COMPARISON
    nowhere = RegionSpec("Nowhere", "%")
    empty = reports.regional_report(regional_consumption(used, scores, nowhere), scores, used, nowhere).first()
    assert (empty.total_meters_after_quality_filter, empty.over_consumers_gwh) == (0, None)


def test_top_and_summary(spark):
    used = sample(spark)
    top = reports.top_violators(violators(used, all_good(spark, used)), 1).collect()
    assert [r.meter_id for r in top] == ["lower"]
    flagged = used.withColumn("data_quality_flag", F.lit("COMPLETE")).withColumn("total_avg_consumption", F.lit(1.25))
    assert [r.meter_id for r in reports.top_complete(flagged, 2).collect()] == ["bad", "both"]
    summary = reports.region_summary(flagged).collect()
    assert [tuple(r) for r in summary] == [("Central", 6, 1.25, 18e6, 5.4e6), ("Western", 1, 1.25, 3e6, 9e5)]


def test_days_add_up_to_the_same_results(spark):
    """Per-meter totals, quality, daily usage and statistics from the meters' days equal those from the readings."""
    from wattline.operators.consumption import consumption_of_totals, daily_usage_of_days, meter_days, totals_of_days
    from wattline.operators.quality import quality_of_days
    from wattline.operators.stats import exclusion_stats, staging_stats

    rows = [(m, datetime(2024, 1 + d // 28, 1 + d % 28, h, 30), w) for m in ("a", "b") for d in range(40) for h, w in ((1, 0.0), (9, 1.5 + d), (22, None), (23, 7.25))]
    staged = readings(spark, [*rows, ("c", None, 3.0), (None, datetime(2024, 1, 3), 4.0)])
    located, common = places(spark, "a", "b"), calendar(spark, [date(2023, m, d) for m in (1, 2) for d in range(1, 29)])
    periods = attach_periods(staged, located, common)
    days = meter_days(periods)
    info = located.selectExpr("meter_id", "60.0 as multiplication_factor", "'r' as region", "'p' as province")

    def same(one, two):
        return sorted(map(str, one.select(two.columns).collect())) == sorted(map(str, two.collect()))

    assert days.count() == 40 * 2 + 1  # rows without a full key are one
    assert same(consumption(periods, info), consumption_of_totals(totals_of_days(days), info))
    assert same(daily_usage(staged), daily_usage_of_days(days))
    assert same(meter_quality(staged), quality_of_days(days))
    at, bounds = datetime(2024, 3, 1), (date(2024, 1, 5), date(2024, 1, 9))
    assert same(staging_stats(staged, staged, "r", at), staging_stats(staged, days, "r", at))
    for limits in (bounds, None):
        assert same(exclusion_stats(staged, limits, "r", at), exclusion_stats(days, limits, "r", at))
