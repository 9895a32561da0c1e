"""Run statistics: one row per stage, all with the columns of ``STATS_SCHEMA``."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions import half_up
from wattline.operators.staging import exclusion_active
from wattline.spec import STATS_SCHEMA


def as_stats(df: DataFrame) -> DataFrame:
    """All statistics columns in order; absent ones are null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in STATS_SCHEMA.fields
        ]
    )


def stats_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Statistics records as a frame; error text is cut at 500 characters."""
    tuples = []
    for row in rows:
        unknown = set(row) - set(STATS_SCHEMA.names)
        if unknown:
            raise ValueError(f"not statistics columns: {sorted(unknown)}")
        if row.get("error_message"):
            row = {**row, "error_message": row["error_message"][:500]}
        tuples.append(tuple({"status": "success", **row}.get(name) for name in STATS_SCHEMA.names))
    return spark.createDataFrame(tuples, STATS_SCHEMA)


def _run(run_id: str, run_timestamp: datetime, stage: str) -> dict[str, Column]:
    return {
        "run_id": F.lit(run_id),
        "run_timestamp": F.lit(run_timestamp).cast("timestamp_ntz"),
        "source_filename": F.lit("all_files"),
        "stage_name": F.lit(stage),
        "status": F.lit("success"),
    }


def _counts(staged: DataFrame) -> tuple[Column, Column, Column]:
    """Readings, readings without power and with zero power that a row stands for."""
    if "readings_count" in staged.columns:
        return F.col("readings_count"), F.col("null_readings"), F.col("zero_readings")
    watts = F.col("active_power_watts")
    return F.lit(1).cast("long"), watts.isNull().cast("long"), F.coalesce((watts == 0).cast("long"), F.lit(0))


def staging_stats(clean: DataFrame, staged: DataFrame, run_id: str, run_timestamp: datetime) -> DataFrame:
    """What deduplication and masking did, as one row. ``clean`` is the readings, or the days of the fact table; ``staged`` is the
    staged readings, or the meters' days."""
    raw = clean.agg(F.coalesce(F.sum("fact_rows"), F.lit(0)) if "fact_rows" in clean.columns else F.count("*"))
    rows, nulls, zeros = _counts(staged)
    out = staged.agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("rows_output"),
        F.countDistinct("meter_id").alias("unique_meters"),
        F.min("reading_date").alias("min_reading_date"),
        F.max("reading_date").alias("max_reading_date"),
        F.coalesce(F.sum(nulls), F.lit(0)).alias("rows_with_null_power"),
        F.coalesce(F.sum(zeros), F.lit(0)).alias("rows_with_zero_power"),
    ).withColumn("rows_input", raw.scalar())
    return as_stats(
        out.withColumns(
            {
                **_run(run_id, run_timestamp, "staging"),
                "rows_filtered": F.col("rows_input") - F.col("rows_output"),
                "filter_reason": F.lit("dedup_and_outliers"),
            }
        )
    )


def exclusion_stats(
    staged: DataFrame, bounds: tuple[date | None, date | None] | None, run_id: str, run_timestamp: datetime
) -> DataFrame:
    """What the date exclusion did, as one row from one pass over the staged readings or the meters' days.

    ``rows_filtered`` counts rows inside the bounds; undated rows leave the output without being
    counted there.
    """
    active = exclusion_active(bounds)
    day = F.col("reading_date")
    inside = day.between(F.lit(bounds[0]), F.lit(bounds[1])) if active else F.lit(False)
    rows = _counts(staged)[0]

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, rows)), F.lit(0))

    counts = staged.agg(
        total(F.lit(True)).alias("rows_input"),
        total(~inside).alias("rows_output"),
        total(inside).alias("rows_filtered"),
        F.countDistinct(F.when(~inside, F.col("meter_id"))).alias("unique_meters"),
        F.min(F.when(~inside, day)).alias("min_reading_date"),
        F.max(F.when(~inside, day)).alias("max_reading_date"),
    )
    label = f"ramadan_dates_{bounds[0]}_to_{bounds[1]}" if active else ""
    reason = F.when(F.col("rows_filtered") > 0, F.lit(label)).otherwise("no_ramadan_filter_active")
    return as_stats(counts.withColumns({**_run(run_id, run_timestamp, "ramadan_filter"), "filter_reason": reason}))


def file_stats(
    clean: DataFrame,
    inputs: DataFrame,
    run_id: str,
    run_timestamp: datetime,
    seconds: float | None = None,
) -> DataFrame:
    """One row per input file: counts of what was written beside what was read.

    ``clean`` carries ``source_filename``; ``inputs`` has the same name under ``path`` (else ``source_filename``),
    file_size_bytes, rows_input (null: the file was not read) and, where a file was turned away, its ``problem``.
    The rows show base names. A missing meter id counts as one distinct value. Files without any written
    row are reported as failed, with their problem.
    """
    watts, at = F.col("IMPORT_ACTIVE_POWER"), F.col("DATA_TIME")
    key = "path" if "path" in inputs.columns else "source_filename"
    profile = clean.groupBy(F.col("source_filename").alias(key)).agg(
        F.count("*").alias("rows_output"),
        (F.countDistinct("METER_ID") + F.max(F.col("METER_ID").isNull().cast("int"))).alias("unique_meters"),
        F.to_date(F.min(at)).alias("min_reading_date"),
        F.to_date(F.max(at)).alias("max_reading_date"),
        F.count_if(watts.isNull()).alias("rows_with_null_power"),
        F.count_if(watts == 0).alias("rows_with_zero_power"),
    )
    joined = inputs.join(profile, key, "left").withColumn("rows_input", F.coalesce("rows_input", F.lit(0)))
    nothing = F.lit("no rows written")
    problem = F.coalesce("problem", nothing) if "problem" in inputs.columns else nothing
    failed = F.col("rows_output").isNull()
    lost = F.col("rows_input") - F.col("rows_output")
    return as_stats(
        joined.withColumns(
            {
                **_run(run_id, run_timestamp, "etl"),
                "source_filename": F.element_at(F.split(key, "/"), -1),
                "rows_filtered": F.when(~failed, F.when(F.col("rows_input") > 0, lost).otherwise(0)),
                "filter_reason": F.when(lost > 0, "date_parse_failures"),
                "processing_seconds": F.lit(seconds),
                "status": F.when(failed, "failed").otherwise("success"),
                "error_message": F.when(failed, F.substring(problem, 1, 500)),
            }
        )
    )


def not_yet_run(stats: DataFrame, recorded: DataFrame) -> DataFrame:
    """Rows whose run id is not recorded yet, with the meaning of SQL ``NOT IN``: a recorded null id
    blocks every row. Stays exact for null ids without collecting anything."""
    ids = recorded.select(F.col("run_id").alias("seen")).distinct()
    has_null = ids.agg(F.count_if(F.col("seen").isNull()) > 0)
    anything = ids.agg(F.count("*") > 0)
    open_ids = stats.where(~has_null.scalar()).where(F.col("run_id").isNotNull() | ~anything.scalar())
    return open_ids.join(ids, open_ids["run_id"] == ids["seen"], "left_anti")


def latest_run(stats: DataFrame) -> DataFrame:
    """Rows of the largest run id (as text), by time."""
    last = stats.agg(F.max("run_id"))
    return stats.where(F.col("run_id") == last.scalar()).orderBy("run_timestamp", "stage_name", "source_filename")


def filter_effectiveness(stats: DataFrame) -> DataFrame:
    """Rows in, rows filtered and their share, per day and stage, latest day first."""
    share = F.try_divide(F.sum("rows_filtered"), F.sum("rows_input")) * 100.0
    return (
        stats.groupBy(F.to_date("run_timestamp").alias("run_date"), "stage_name")
        .agg(
            F.sum("rows_input").alias("total_input"),
            F.sum("rows_filtered").alias("total_filtered"),
            half_up(share, 2).alias("filter_pct"),
        )
        .orderBy(F.desc("run_date"), "stage_name")
    )


def to_json_rows(stats: DataFrame) -> DataFrame:
    """One JSON text per row, nulls kept."""
    return stats.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


def from_json_rows(texts: DataFrame) -> DataFrame:
    return as_stats(texts.select(F.from_json("json", STATS_SCHEMA).alias("s")).select("s.*"))
