"""Cleaned frames: readings, yearly schedule and sites."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from wattline.functions import (
    canonical_id,
    clock_text_to_seconds,
    half_up,
    latlon_text,
    quarter_label,
    safe_double,
    second_of_day,
)
from wattline.spec import PRESET, OutlierSpec


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in ``order``. Null keys form one group.

    Spark limits each key to one row per task before the shuffle, so a hot key stays cheap.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def mask_outliers(watts: Column, spec: OutlierSpec = PRESET.outliers) -> Column:
    """Null outside the bounds (the bounds themselves are kept), three fractional digits."""
    return F.when((watts >= spec.low) & (watts <= spec.high), half_up(watts, 3))


def _raw(clean: DataFrame) -> DataFrame:
    return clean.select(
        F.col("METER_ID").cast("string").alias("meter_id"),
        F.col("DATA_TIME").alias("reading_at"),
        F.col("IMPORT_ACTIVE_POWER").alias("watts"),
    )


def _has_key() -> Column:
    return F.col("meter_id").isNotNull() & F.col("reading_at").isNotNull()


def _inside(spec: OutlierSpec) -> Column:
    watts = F.col("watts")
    return F.when((watts >= spec.low) & (watts <= spec.high), watts)


def _staged(chosen: DataFrame) -> DataFrame:
    return chosen.select(
        "meter_id",
        "reading_at",
        half_up(F.col("watts"), 3).alias("active_power_watts"),
        F.to_date("reading_at").alias("reading_date"),
        second_of_day(F.col("reading_at")).alias("reading_time"),
        quarter_label(F.col("reading_at")).alias("quarter"),
    )


def stage_keyed(clean: DataFrame, spec: OutlierSpec = PRESET.outliers) -> DataFrame:
    """The staged rows that have meter and time.

    Of several rows with one key the one with the highest power inside the bounds is kept: a copy that is
    out of bounds (or NaN) never displaces a good one. Every other staged column is a function of the key, so that
    row is just the maximum of the power: a hash aggregate that already collapses copies before the
    shuffle, with no sort and no window.
    """
    keyed = _raw(clean).where(_has_key()).groupBy("meter_id", "reading_at").agg(F.max(_inside(spec)).alias("watts"))
    return _staged(keyed)


def _first_unkeyed(spec: OutlierSpec) -> Column:
    """What the row kept of those lacking meter or time has least of, as a whole; null for rows that have both."""
    watts = _inside(spec)
    first = F.struct(
        watts.isNull().alias("no_watts"),
        (-watts).alias("falling"),
        F.col("meter_id").isNull().alias("no_meter"),
        "meter_id",
        "reading_at",
        watts.alias("watts"),
    )
    return F.min(F.when(~_has_key(), first))


def stage_unkeyed(clean: DataFrame, spec: OutlierSpec = PRESET.outliers) -> DataFrame:
    """Rows lacking meter or time share one key, so at most one staged row in all."""
    return unkeyed_of_days(_raw(clean).where(~_has_key()).agg(_first_unkeyed(spec).alias("unkeyed")))


def fact_days(clean: DataFrame, day: str, spec: OutlierSpec = PRESET.outliers) -> DataFrame:
    """Per day of the fact table its number of rows (``fact_rows``) and its candidate for the one staged row without a full key, so
    both follow for all days from a row per day."""
    rows = clean.select(F.col(day).alias("_day"), F.col("METER_ID").cast("string").alias("meter_id"), F.col("DATA_TIME").alias("reading_at"), F.col("IMPORT_ACTIVE_POWER").alias("watts"))
    return rows.groupBy(F.col("_day").alias(day)).agg(F.count("*").alias("fact_rows"), _first_unkeyed(spec).alias("unkeyed"))


def unkeyed_of_days(days: DataFrame) -> DataFrame:
    """The staged row without a full key, from the candidates of ``fact_days``."""
    one = days.agg(F.min("unkeyed").alias("row")).where("row is not null")
    return _staged(one.select("row.meter_id", "row.reading_at", "row.watts"))


def stage_readings(clean: DataFrame, spec: OutlierSpec = PRESET.outliers) -> DataFrame:
    """One row per meter and time, outliers masked, calendar parts derived.

    ``clean`` has METER_ID, DATA_TIME (zone-free, whole minutes) and IMPORT_ACTIVE_POWER; names are
    matched case-insensitively.
    """
    return stage_keyed(clean, spec).unionByName(stage_unkeyed(clean, spec))


def exclude_dates(staged: DataFrame, bounds: tuple[date | None, date | None] | None) -> DataFrame:
    """Drop readings dated inside the inclusive bounds; inactive unless both are set.

    When active, undated readings drop out too (their comparison is null).
    """
    if not exclusion_active(bounds):
        return staged
    return staged.where(~F.col("reading_date").between(F.lit(bounds[0]), F.lit(bounds[1])))


def exclusion_active(bounds: tuple[date | None, date | None] | None) -> bool:
    return bounds is not None and bounds[0] is not None and bounds[1] is not None


def stage_schedule(schedule: DataFrame) -> DataFrame:
    """Parse the yearly schedule: coordinate text, ``DD-MM-YYYY`` dates, ``HH:MM`` times as seconds of day."""
    lat, lon = latlon_text(F.col("Coordinate"))
    return schedule.select(
        lat.alias("lat"),
        lon.alias("lon"),
        F.col("Coordinate").alias("original_coordinate"),
        strict_date(F.col("Date")).alias("date"),
        clock_text_to_seconds(F.col("Fajr")).alias("fajr_time"),
        clock_text_to_seconds(F.col("Dhuhr")).alias("dhuhr_time"),
        clock_text_to_seconds(F.col("Asr")).alias("asr_time"),
        clock_text_to_seconds(F.col("Maghrib")).alias("maghrib_time"),
        clock_text_to_seconds(F.col("Isha")).alias("isha_time"),
    )


def strict_date(text: Column) -> Column:
    """``DD-MM-YYYY`` to date; malformed text fails the query in every session mode."""
    parsed = F.try_to_date(text, "dd-MM-yyyy")
    bad = text.isNotNull() & parsed.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("not a DD-MM-YYYY date: "), text)).cast("date")).otherwise(parsed)


def stage_sites(sites: DataFrame) -> DataFrame:
    """Site catalogue: unusable factors become 1.0, unusable coordinates a null point."""
    lat = F.col("Y Coordinates").try_cast("double")
    lon = F.col("X Coordinates").try_cast("double")
    both = lat.isNotNull() & lon.isNotNull()
    factor = safe_double(F.nullif(F.trim(F.col("Multiplication Factor")), F.lit("#")))
    return sites.select(
        canonical_id(F.col("Meter Number")).alias("meter_id"),
        F.coalesce(factor, F.lit(1.0)).alias("multiplication_factor"),
        F.when(both, lat).alias("lat"),
        F.when(both, lon).alias("lon"),
        F.col("Region").alias("region"),
        F.col("Province").alias("province"),
        F.col("Department Name").alias("department_name"),
        F.col("Office Name").alias("office_name"),
    )
