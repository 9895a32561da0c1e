"""Reports over the per-meter tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions import half_up
from wattline.operators.violations import in_region
from wattline.spec import COMPARISON, PRESET, RegionSpec


def _exact(x: Column | str) -> Column:
    """Three-digit values as decimals: sums do not depend on task order."""
    return (F.col(x) if isinstance(x, str) else x).cast("decimal(20,3)")


def regional_report(
    regional: DataFrame,
    quality: DataFrame,
    locations: DataFrame,
    region: RegionSpec = PRESET.region,
    comparison: dict | None = None,
) -> DataFrame:
    """One row: meter counts before and after the quality filter, flag counts, energy and cost of
    flagged and unflagged periods in millions, and published numbers for comparison.

    Energy and cost are split per period: a meter over the limit in the morning only adds its
    evening to the regular side.
    """
    before = (
        quality.select("meter_id")
        .join(locations.where(in_region(region)).select("meter_id"), "meter_id")
        .agg(F.countDistinct("meter_id"))
    )

    def both_periods(measure: str, flagged: bool) -> Column:
        def one(period: str) -> Column:
            flag = F.col(f"over_in_{period}")
            return F.sum(F.when(flag if flagged else ~flag, _exact(f"{period}_{measure}")).otherwise(0))

        return one("morning") + one("evening")

    sums = regional.agg(
        F.countDistinct("meter_id").alias("total_meters_after_quality_filter"),
        F.count_if("over_in_morning").alias("overs_morning"),
        F.count_if("over_in_evening").alias("overs_evening"),
        F.count_if("over_in_both").alias("overs_both"),
        F.count_if("over_in_either").alias("overs_either"),
        both_periods("energy_kwh", True).alias("over_kwh"),
        both_periods("cost_sar", True).alias("over_cost"),
        both_periods("energy_kwh", False).alias("regular_kwh"),
        both_periods("cost_sar", False).alias("regular_cost"),
    )

    def millions(name: str) -> Column:
        return half_up(F.col(name).cast("double") / 1e6, 2)

    published = COMPARISON if comparison is None else comparison
    return sums.select(
        before.scalar().alias("total_meters_before_quality_filter"),
        "total_meters_after_quality_filter",
        "overs_morning",
        "overs_evening",
        "overs_both",
        "overs_either",
        millions("over_kwh").alias("over_consumers_gwh"),
        millions("over_cost").alias("over_consumers_cost_million_sar"),
        millions("regular_kwh").alias("regular_consumers_gwh"),
        millions("regular_cost").alias("regular_consumers_cost_million_sar"),
        *[F.lit(value).alias(name) for name, value in published.items()],
    )


def region_summary(consumption: DataFrame) -> DataFrame:
    """Meters, average consumption, energy and cost per region, most energy first."""
    mean = F.sum(_exact("total_avg_consumption")).cast("double") / F.nullif(F.count("total_avg_consumption"), F.lit(0))
    return (
        consumption.groupBy("region")
        .agg(
            F.count("*").alias("meter_count"),
            half_up(mean, 2).alias("avg_consumption_w"),
            half_up(F.sum(_exact("total_energy_kwh")).cast("double"), 2).alias("total_energy_kwh"),
            half_up(F.sum(_exact("total_cost_sar")).cast("double"), 2).alias("total_cost_sar"),
        )
        .orderBy(F.desc_nulls_last("total_energy_kwh"), "region")
    )


def top_violators(violators: DataFrame, k: int = 20) -> DataFrame:
    """Meters over the limit in both periods with the largest possible saving."""
    return (
        violators.where("over_in_both")
        .orderBy(F.desc_nulls_last("total_potential_savings_sar"), "meter_id")
        .limit(k)
        .select(
            "meter_id",
            "violation_category",
            F.col("morning_avg_mf").alias("morning_watts"),
            F.col("evening_avg_mf").alias("evening_watts"),
            "total_potential_savings_sar",
        )
    )


def top_complete(consumption: DataFrame, k: int = 10) -> DataFrame:
    """Meters with data in both periods that use the most energy."""
    complete = consumption.where(F.col("data_quality_flag") == "COMPLETE")
    return complete.orderBy(F.desc_nulls_last("total_energy_kwh"), "meter_id").limit(k)
