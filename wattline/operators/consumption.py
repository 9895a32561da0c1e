"""Per-meter and per-day consumption."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions import half_up, milli, quarter_label
from wattline.operators.periods import in_evening, in_morning
from wattline.spec import PRESET, EnergySpec, PeriodSpec


def _totals(prefix: str, condition: Column | None) -> dict[str, Column]:
    """Exact sum (thousandths of a watt) and count of the non-null readings under a condition."""
    watts = F.col("active_power_watts")
    if condition is not None:
        watts = F.when(condition, watts)
    return {f"{prefix}_milli": F.sum(milli(watts)), f"{prefix}_reading_count": F.count(watts)}


PREFIXES = ("total", "morning", "evening")


def _mean(total: str, n: str) -> Column:
    """Unrounded mean of thousandths, in whole units; null without readings."""
    return F.col(total).cast("double") / F.nullif(F.col(n) * 1000, F.lit(0)).cast("double")


def meter_totals(periods: DataFrame, spec: PeriodSpec = PRESET.periods) -> DataFrame:
    """Totals per meter over all, morning and evening readings.

    One pass with fixed-width aggregation state only (sums as whole numbers, the quarter derived
    from the earliest date), so this is a hash aggregate with partial sums before the shuffle: a
    meter with very many readings costs one row per task. The quarter is that of the earliest
    reading, also for meters with readings in several quarters.
    """
    flagged = periods.withColumns({"_morning": in_morning(spec), "_evening": in_evening()})
    aggregates = {
        **_totals("total", None),
        **_totals("morning", F.col("_morning")),
        **_totals("evening", F.col("_evening")),
        "min_reading_date": F.min("reading_date"),
        "max_reading_date": F.max("reading_date"),
        "readings_with_prayer_times": F.count("morning_start_time"),
    }
    return _with_means(flagged.groupBy("meter_id").agg(*[c.alias(n) for n, c in aggregates.items()]))


def _with_means(grouped: DataFrame) -> DataFrame:
    # unrounded means are columns of their own, so that rounding does not repeat their expressions
    means = grouped.withColumns({f"{p}_mean": _mean(f"{p}_milli", f"{p}_reading_count") for p in PREFIXES})
    return means.select(
        "meter_id",
        *[
            column
            for p in PREFIXES
            for column in (
                half_up(F.col(f"{p}_mean"), 3).alias(f"{p}_avg_consumption"),
                (F.col(f"{p}_milli").cast("double") / 1000.0).alias(f"{p}_sum_consumption"),
                F.col(f"{p}_reading_count"),
            )
        ],
        "min_reading_date",
        "max_reading_date",
        "readings_with_prayer_times",
        quarter_label(F.col("min_reading_date")).alias("quarter"),
    )


def meter_days(periods: DataFrame, spec: PeriodSpec = PRESET.periods) -> DataFrame:
    """One additive row per meter and day, from which all per-meter, per-day and run totals follow.

    Sums are whole thousandths and everything else is a count, a maximum or a minimum, so rows of different days
    combine exactly, in any order.
    """
    flagged = periods.withColumns({"_morning": in_morning(spec), "_evening": in_evening()})
    watts = F.col("active_power_watts")
    aggregates = {
        **_totals("total", None),
        **_totals("morning", F.col("_morning")),
        **_totals("evening", F.col("_evening")),
        "readings_with_prayer_times": F.count("morning_start_time"),
        "readings_count": F.count("*"),
        "null_readings": F.count_if(watts.isNull()),
        "zero_readings": F.count_if(watts == 0),
        "max_daily_power_watts": F.max(watts),
        "min_daily_power_watts": F.min(watts),
    }
    return flagged.groupBy("meter_id", "reading_date").agg(*[c.alias(n) for n, c in aggregates.items()])


def totals_of_days(days: DataFrame) -> DataFrame:
    """The same totals per meter as ``meter_totals`` gives, from the meters' days."""
    summed = [f"{p}_{n}" for p in PREFIXES for n in ("milli", "reading_count")] + ["readings_with_prayer_times"]
    grouped = days.groupBy("meter_id").agg(
        *[F.sum(c).alias(c) for c in summed],
        F.min("reading_date").alias("min_reading_date"),
        F.max("reading_date").alias("max_reading_date"),
    )
    return _with_means(grouped)


def completeness_label(morning: Column, evening: Column) -> Column:
    return (
        F.when(morning.isNull() & evening.isNull(), "NO_PERIOD_DATA")
        .when(morning.isNull(), "NO_MORNING_DATA")
        .when(evening.isNull(), "NO_EVENING_DATA")
        .otherwise("COMPLETE")
    )


def consumption(
    periods: DataFrame,
    locations: DataFrame,
    period_spec: PeriodSpec = PRESET.periods,
    energy: EnergySpec = PRESET.energy,
) -> DataFrame:
    """Consumption, energy and cost per meter that has readings in at least one period, from readings with periods."""
    return consumption_of_totals(meter_totals(periods, period_spec), locations, energy)


def consumption_of_totals(totals: DataFrame, locations: DataFrame, energy: EnergySpec = PRESET.energy) -> DataFrame:
    """Consumption, energy and cost from totals per meter.

    Energy and cost start from the rounded sums; cost rounds once, from unrounded energy. The join
    is between per-meter frames, after aggregation.
    """
    # an average is there exactly when its period has a non-null reading
    totals = totals.where("morning_reading_count > 0 or evening_reading_count > 0")
    info = locations.select("meter_id", "multiplication_factor", "region", "province")

    def kwh(prefix: str) -> Column:
        scaled = F.col(f"{prefix}_sum_consumption") * F.col("multiplication_factor")
        return scaled / float(energy.readings_per_hour) / 1000.0

    raw = {f"{p}_kwh": kwh(p) for p in PREFIXES} | {f"{p}_cost": kwh(p) * energy.tariff for p in PREFIXES}
    return (
        totals.join(info, "meter_id", "left")
        .withColumns(raw)
        .select(
            *totals.columns,
            "multiplication_factor",
            "region",
            "province",
            *[half_up(F.col(f"{p}_kwh"), 3).alias(f"{p}_energy_kwh") for p in PREFIXES],
            *[half_up(F.col(f"{p}_cost"), 3).alias(f"{p}_cost_sar") for p in PREFIXES],
            completeness_label(F.col("morning_avg_consumption"), F.col("evening_avg_consumption")).alias(
                "data_quality_flag"
            ),
        )
    )


def daily_usage(staged: DataFrame) -> DataFrame:
    """Daily power statistics per meter."""
    watts = F.col("active_power_watts")
    grouped = staged.groupBy("meter_id", "reading_date").agg(
        F.sum(milli(watts)).alias("total"),
        F.count(watts).alias("n"),
        F.max(watts).alias("max_daily_power_watts"),
        F.min(watts).alias("min_daily_power_watts"),
        F.count("*").alias("readings_count"),
    )
    return _daily(grouped.withColumn("mean", _mean("total", "n")))


def daily_usage_of_days(days: DataFrame) -> DataFrame:
    """The same as ``daily_usage`` gives, from the meters' days: no grouping is left to do."""
    return _daily(days.withColumn("mean", _mean("total_milli", "total_reading_count")))


def _daily(means: DataFrame) -> DataFrame:
    return means.select(
        "meter_id",
        F.col("reading_date").alias("date"),
        quarter_label(F.col("reading_date")).alias("quarter"),
        half_up(F.col("mean"), 3).alias("avg_daily_power_watts"),
        "max_daily_power_watts",
        "min_daily_power_watts",
        "readings_count",
    )
