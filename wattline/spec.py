"""Parameters, fixed values and table schemas."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Input contract of raw reading files.
# --------------------------------------------------------------------------

READING_COLUMNS = [
    "METER_ID",
    "ID",
    "METER_NO",
    "DATA_TIME",
    "IMPORT_ACTIVE_POWER",
    "IMPORT_REACTIVE_POWER",
    "IMPORT_APPARENT_POWER",
    "REACTIVE_POWER_IMPORT",
    "EXPORT_ACTIVE_POWER",
    "EXPORT_REACTIVE_POWER",
    "EXPORT_APPARENT_POWER",
    "REACTIVE_POWER_EXPORT",
    "IMPORT_FACTOR_POWER",
    "EXPORT_FACTOR_POWER",
    "STATUS",
]

REQUIRED_COLUMNS = ["METER_ID", "DATA_TIME", "IMPORT_ACTIVE_POWER"]

# Power columns cast to double when a file carries the whole layout.
POWER_COLUMNS = [
    "IMPORT_ACTIVE_POWER",
    "EXPORT_ACTIVE_POWER",
    "IMPORT_REACTIVE_POWER",
    "EXPORT_REACTIVE_POWER",
]

# Accepted spellings of the required columns; the first one present wins.
HEADER_ALIASES = {
    "METER_ID": ["METER_ID", "METERID", "METER", "MTR_ID", "ID_METER"],
    "DATA_TIME": [
        "DATA_TIME",
        "DATATIME",
        "DATETIME",
        "DATE_TIME",
        "READING_DATETIME",
        "READ_TIME",
        "TIMESTAMP",
        "TIME",
        "DT",
        "READING_TIME",
        "READ_DATETIME",
    ],
    "IMPORT_ACTIVE_POWER": [
        "IMPORT_ACTIVE_POWER",
        "IMPORTACTIVEPOWER",
        "ACTIVE_IMPORT_POWER",
        "ACTIVE_IMP_POWER",
        "IMP_ACTIVE_POWER",
        "IMPORT_POWER",
        "ACTIVE_POWER",
        "KW_IMPORT",
        "KW_IMP",
        "POWER_IMPORT",
    ],
}

# Candidate separators; earlier ones win ties.
SEPARATORS = [",", ";", "\t", "|"]

# --------------------------------------------------------------------------
# Model parameters. The defaults are the published preset.
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class OutlierSpec:
    """Readings outside ``[low, high]`` watts become null."""

    low: float = 0.0
    high: float = 1_000_000_000.0


@dataclass(frozen=True)
class PeriodSpec:
    """Minutes added to the schedule times to get the period bounds."""

    morning_start_after_fajr: int = 100
    morning_end_after_dhuhr: int = -80
    evening_start_after_isha: int = 90
    evening_end_after_fajr: int = -80
    skip_weekday: int = 6  # 1 = Sunday, so 6 = Friday; mornings only


@dataclass(frozen=True)
class QualitySpec:
    per_day: int = 48
    good_percent: float = 50.0


@dataclass(frozen=True)
class EnergySpec:
    readings_per_hour: int = 2
    tariff: float = 0.32


@dataclass(frozen=True)
class ThresholdSpec:
    limit_watts: float = 3000.0
    normal_watts: float = 500.0


@dataclass(frozen=True)
class RegionSpec:
    region: str = "Central"
    province_like: str = "%RIYADH%"


# Published comparison numbers shown beside the computed regional report.
COMPARISON = {
    "team_total_meters_before": 14094,
    "team_total_meters_after": 12673,
    "team_overs_morning": 6591,
    "team_overs_evening": 7027,
    "team_overs_both": 5959,
    "team_overs_either": 7659,
    "team_over_consumers_gwh": 60.34,
    "team_over_consumers_cost_million_sar": 19.31,
    "team_regular_consumers_gwh": 6.42,
    "team_regular_consumers_cost_million_sar": 2.06,
}


@dataclass(frozen=True)
class ModelSpec:
    """Everything a whole model run can vary."""

    outliers: OutlierSpec = OutlierSpec()
    periods: PeriodSpec = PeriodSpec()
    quality: QualitySpec = QualitySpec()
    energy: EnergySpec = EnergySpec()
    threshold: ThresholdSpec = ThresholdSpec()
    region: RegionSpec = RegionSpec()
    exclude: tuple[date | None, date | None] | None = None
    comparison: dict = field(default_factory=lambda: dict(COMPARISON))


PRESET = ModelSpec()

# --------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------

STATS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("run_timestamp", T.TimestampNTZType(), False),
        T.StructField("source_filename", T.StringType(), False),
        T.StructField("quarter", T.StringType()),
        T.StructField("stage_name", T.StringType(), False),
        T.StructField("rows_input", T.LongType()),
        T.StructField("rows_output", T.LongType()),
        T.StructField("rows_filtered", T.LongType()),
        T.StructField("filter_reason", T.StringType()),
        T.StructField("unique_meters", T.LongType()),
        T.StructField("min_reading_date", T.DateType()),
        T.StructField("max_reading_date", T.DateType()),
        T.StructField("processing_seconds", T.DoubleType()),
        T.StructField("file_size_bytes", T.LongType()),
        T.StructField("rows_with_null_power", T.LongType()),
        T.StructField("rows_with_zero_power", T.LongType()),
        T.StructField("rows_duplicates_skipped", T.LongType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("error_message", T.StringType()),
    ]
)

SCHEDULE_CSV_SCHEMA = "Coordinate string, Date string, Fajr string, Dhuhr string, Asr string, Maghrib string, Isha string"

SITES_CSV_SCHEMA = (
    "`Meter Number` string, `Multiplication Factor` string, `X Coordinates` string, `Y Coordinates` string, "
    "Region string, Province string, `Department Name` string, `Office Name` string"
)
