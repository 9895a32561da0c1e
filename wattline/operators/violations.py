"""Meters above the power threshold, overall and per region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions import half_up
from wattline.spec import PRESET, EnergySpec, RegionSpec, ThresholdSpec

_CARRIED = [
    "meter_id",
    "quarter",
    "morning_avg_consumption",
    "morning_sum_consumption",
    "morning_reading_count",
    "evening_avg_consumption",
    "evening_sum_consumption",
    "evening_reading_count",
    "morning_energy_kwh",
    "evening_energy_kwh",
    "total_energy_kwh",
    "morning_cost_sar",
    "evening_cost_sar",
    "total_cost_sar",
    "multiplication_factor",
    "region",
    "province",
    "min_reading_date",
    "max_reading_date",
]
_QUALITY = ["quality_percentage", "actual_readings", "zero_readings", "missing_readings"]


def with_quality(consumption: DataFrame, quality: DataFrame) -> DataFrame:
    """Consumption of the meters with good quality, with their quality columns."""
    good = quality.where("is_good_quality").select("meter_id", *_QUALITY, "is_good_quality")
    return consumption.select(*_CARRIED).join(good, "meter_id")


def flag_over(df: DataFrame, spec: ThresholdSpec = PRESET.threshold) -> DataFrame:
    """Scaled averages and the four threshold flags; a missing average is never over."""

    def over(scaled: str) -> Column:
        return F.coalesce(F.col(scaled) > spec.limit_watts, F.lit(False))

    return (
        df.withColumns(
            {
                "morning_avg_mf": F.col("morning_avg_consumption") * F.col("multiplication_factor"),
                "evening_avg_mf": F.col("evening_avg_consumption") * F.col("multiplication_factor"),
            }
        )
        .withColumns({"over_in_morning": over("morning_avg_mf"), "over_in_evening": over("evening_avg_mf")})
        .withColumns(
            {
                "over_in_both": F.col("over_in_morning") & F.col("over_in_evening"),
                "over_in_either": F.col("over_in_morning") | F.col("over_in_evening"),
            }
        )
    )


def violation_category() -> Column:
    return (
        F.when(F.col("over_in_both"), "BOTH_PERIODS")
        .when(F.col("over_in_morning"), "MORNING_ONLY")
        .when(F.col("over_in_evening"), "EVENING_ONLY")
        .otherwise("COMPLIANT")
    )


def violators(
    consumption: DataFrame,
    quality: DataFrame,
    threshold: ThresholdSpec = PRESET.threshold,
    energy: EnergySpec = PRESET.energy,
) -> DataFrame:
    """Good-quality meters over the limit in some period, with the saving from going back to normal."""
    flagged = flag_over(with_quality(consumption, quality).drop("is_good_quality"), threshold)

    def unrounded(prefix: str) -> Column:
        surplus = (F.col(f"{prefix}_avg_mf") - threshold.normal_watts) * F.col(f"{prefix}_reading_count")
        return surplus / float(energy.readings_per_hour) / 1000.0 * energy.tariff

    def saving(prefix: str) -> Column:
        return F.when(F.col(f"over_in_{prefix}"), half_up(F.col(f"_{prefix}_saving"), 3)).otherwise(0.0)

    return (
        flagged.where("over_in_either")
        .withColumns({f"_{p}_saving": unrounded(p) for p in ("morning", "evening")})
        .withColumns(
            {
                "violation_category": violation_category(),
                "potential_savings_morning_sar": saving("morning"),
                "potential_savings_evening_sar": saving("evening"),
            }
        )
        .withColumn(
            "total_potential_savings_sar",
            F.col("potential_savings_morning_sar") + F.col("potential_savings_evening_sar"),
        )
        .drop("_morning_saving", "_evening_saving")
    )


def in_region(spec: RegionSpec) -> Column:
    return (F.col("region") == spec.region) & F.col("province").like(spec.province_like)


def regional_consumption(
    consumption: DataFrame,
    quality: DataFrame,
    region: RegionSpec = PRESET.region,
    threshold: ThresholdSpec = PRESET.threshold,
) -> DataFrame:
    """All good-quality meters of one region, over the limit or not."""
    return flag_over(with_quality(consumption.where(in_region(region)), quality), threshold)


def regional_violators(regional: DataFrame) -> DataFrame:
    """Meters over the limit, each row carrying the region's totals.

    The totals come from a one-row aggregate used as a scalar subquery, not from a window without
    partitions, which would move every row to one task.
    """
    over = regional.where("over_in_either")
    totals = over.agg(
        F.struct(
            F.count_if("over_in_morning").alias("total_overs_morning"),
            F.count_if("over_in_evening").alias("total_overs_evening"),
            F.count_if("over_in_both").alias("total_overs_both"),
            F.count_if("over_in_either").alias("total_overs_either"),
            F.count("*").alias("total_violators_riyadh"),
        )
    )
    return over.withColumn("_totals", totals.scalar()).select(*over.columns, "_totals.*")
