"""Daily time-of-day periods from the yearly schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions import add_minutes
from wattline.operators.joins import MAX_BROADCAST_BYTES, join_per_key
from wattline.spec import PRESET, PeriodSpec


def schedule_periods(schedule: DataFrame, spec: PeriodSpec = PRESET.periods) -> DataFrame:
    """Period bounds per location and calendar day (month and day; any year)."""
    fajr, dhuhr, isha = F.col("fajr_time"), F.col("dhuhr_time"), F.col("isha_time")
    return schedule.select(
        F.col("original_coordinate").alias("nearest_prayer_coordinate"),
        F.month("date").alias("_month"),
        F.dayofmonth("date").alias("_day"),
        "fajr_time",
        "dhuhr_time",
        "isha_time",
        add_minutes(fajr, spec.morning_start_after_fajr).alias("morning_start_time"),
        add_minutes(dhuhr, spec.morning_end_after_dhuhr).alias("morning_end_time"),
        add_minutes(isha, spec.evening_start_after_isha).alias("evening_start_time"),
        add_minutes(fajr, spec.evening_end_after_fajr).alias("evening_end_time"),
    )


def attach_periods(
    readings: DataFrame,
    locations: DataFrame,
    schedule: DataFrame,
    spec: PeriodSpec = PRESET.periods,
    *,
    location_rows: int | None = None,
    schedule_rows: int | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Left-join each reading with the periods of its meter's location on that calendar day.

    Readings that find no location or no calendar day keep null periods. A schedule with several
    years repeats readings (see ``schedule_repeats``). Small location and schedule frames are
    broadcast, so the readings are not shuffled at all; see ``join_per_key`` for large ones.
    """
    by_meter = locations.select("meter_id", "nearest_prayer_coordinate")
    located = join_per_key(
        readings,
        by_meter,
        ["meter_id"],
        "left",
        F.col("reading_at"),
        rows=location_rows,
        max_broadcast_bytes=max_broadcast_bytes,
    )
    dated = located.withColumns({"_month": F.month("reading_date"), "_day": F.dayofmonth("reading_date")})
    joined = join_per_key(
        dated,
        schedule_periods(schedule, spec),
        ["nearest_prayer_coordinate", "_month", "_day"],
        "left",
        F.col("meter_id"),
        rows=schedule_rows,
        max_broadcast_bytes=max_broadcast_bytes,
    )
    return joined.select(
        "meter_id",
        "reading_at",
        "active_power_watts",
        "reading_date",
        "reading_time",
        "quarter",
        "fajr_time",
        "dhuhr_time",
        "isha_time",
        "morning_start_time",
        "morning_end_time",
        "evening_start_time",
        "evening_end_time",
    )


def in_morning(spec: PeriodSpec = PRESET.periods) -> Column:
    """Within the bounds and not on the skipped weekday; a wrapped period matches nothing."""
    inside = F.col("reading_time").between(F.col("morning_start_time"), F.col("morning_end_time"))
    return inside & (F.dayofweek("reading_date") != spec.skip_weekday)


def in_evening() -> Column:
    """From the evening start over midnight to the evening end, every day."""
    time = F.col("reading_time")
    return (time >= F.col("evening_start_time")) | (time <= F.col("evening_end_time"))


def schedule_repeats(schedule: DataFrame) -> DataFrame:
    """Locations with more than one schedule row for a calendar day; these repeat readings."""
    return (
        schedule.groupBy("original_coordinate", F.month("date").alias("month"), F.dayofmonth("date").alias("day"))
        .count()
        .where("count > 1")
    )
