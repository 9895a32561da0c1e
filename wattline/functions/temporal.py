from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86400

# Accepted shapes of a reading time: date, or date and time with optional fraction.
READING_TIME_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}(?: \d{1,2}:\d{1,2}:[0-5]?\d(?:\.\d+)?)?$"


def floor_minute(ts: Column) -> Column:
    """Drop the seconds of a zone-free timestamp (no detour through the session zone)."""
    zero = F.lit(0)
    return ts - F.make_dt_interval(zero, zero, zero, F.extract(F.lit("SECONDS"), ts))


def parse_reading_time(text: Column) -> Column:
    """Text to a zone-free timestamp at whole minutes; anything else is null.

    The minute is what stands before the second colon, so no timestamp arithmetic is needed.
    """
    return F.when(text.rlike(READING_TIME_SHAPE), F.substring_index(text, ":", 2).try_cast("timestamp_ntz"))


def time_text(ts: Column) -> Column:
    """``2025-08-02 00:30:00`` from a zone-free timestamp at whole seconds."""
    return ts.cast("timestamp_ntz").cast("string")


def quarter_label(day: Column) -> Column:
    """``2025-Q3`` from a date or timestamp."""
    return F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))


def second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def clock_text_to_seconds(text: Column) -> Column:
    """Strict ``HH:MM`` to second of day; malformed text fails the query, null stays null."""
    return F.when(
        text.rlike(r"^([01]?\d|2[0-3]):[0-5]?\d$"),
        F.split(text, ":")[0].cast("int") * 3600 + F.split(text, ":")[1].cast("int") * 60,
    ).when(
        text.isNotNull(),
        F.raise_error(F.concat(F.lit("not a HH:MM time: "), text)).cast("int"),
    )


def add_minutes(seconds: Column, minutes: int) -> Column:
    """Move a second-of-day by some minutes, wrapping at midnight in both directions."""
    return F.pmod(seconds + 60 * minutes, F.lit(DAY_SECONDS))
