"""Data-quality score per meter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions import half_up
from wattline.spec import PRESET, QualitySpec


def meter_quality(readings: DataFrame, spec: QualitySpec = PRESET.quality) -> DataFrame:
    """Non-zero readings against the number expected over the meter's date span.

    The span does not count its last day, so the score can pass 100 and ``missing_readings`` can be
    negative; meters seen on one day only are left out. The flag uses the unrounded score.
    """
    watts = F.col("active_power_watts")
    grouped = readings.groupBy("meter_id").agg(
        F.min("reading_date").alias("min_date"),
        F.max("reading_date").alias("max_date"),
        F.count("*").alias("actual_readings"),
        F.count_if(watts == 0).alias("zero_readings"),
        F.count_if(watts.isNull()).alias("null_readings"),
    )
    return _scored(grouped, spec)


def quality_of_days(days: DataFrame, spec: QualitySpec = PRESET.quality) -> DataFrame:
    """The same scores as ``meter_quality`` gives, from the meters' days."""
    grouped = days.groupBy("meter_id").agg(
        F.min("reading_date").alias("min_date"),
        F.max("reading_date").alias("max_date"),
        F.sum("readings_count").alias("actual_readings"),
        F.sum("zero_readings").alias("zero_readings"),
        F.sum("null_readings").alias("null_readings"),
    )
    return _scored(grouped, spec)


def _scored(grouped: DataFrame, spec: QualitySpec) -> DataFrame:
    span = F.datediff("max_date", "min_date").cast("bigint")
    scored = grouped.withColumns({"date_range_days": span, "expected_readings": span * spec.per_day}).where(
        "expected_readings > 0"
    )
    score = (F.col("actual_readings") - F.col("zero_readings")) / F.col("expected_readings") * 100.0
    return scored.withColumn("score", score).select(
        "meter_id",
        "min_date",
        "max_date",
        "date_range_days",
        "expected_readings",
        "actual_readings",
        "zero_readings",
        "null_readings",
        (F.col("expected_readings") - F.col("actual_readings")).alias("missing_readings"),
        half_up(F.col("score"), 2).alias("quality_percentage"),
        (F.col("score") >= spec.good_percent).alias("is_good_quality"),
    )
