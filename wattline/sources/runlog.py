"""Where run statistics are kept."""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.operators.loading import absent_rows
from wattline.operators.stats import as_stats, from_json_rows, stats_rows, to_json_rows
from wattline.sources.facts import compact_days
from wattline.sources.tables import _fs, has_data
from wattline.spec import STATS_SCHEMA


def run_id(environment: str = "PIPELINE_RUN_ID") -> str:
    """The run id given by the environment, else one made from the current time."""
    return os.getenv(environment) or f"local_{datetime.now():%Y%m%d_%H%M%S}"


MOST_FILES = 32


def append_stats(stats: DataFrame, path: str) -> None:
    """Append statistics rows, one folder per day of the run. A day that came to hold many small files is packed."""
    dated = as_stats(stats).withColumn("run_date", F.to_date("run_timestamp"))
    dated.sortWithinPartitions("stage_name", "source_filename").write.mode("append").partitionBy("run_date").parquet(path)
    if _most_files(stats.sparkSession, path) > MOST_FILES:
        compact_days(stats.sparkSession, path, "run_date", STATS_SCHEMA, MOST_FILES)


def _most_files(spark: SparkSession, path: str) -> int:
    """The number of files of the newest day, where appends go."""
    fs, root = _fs(spark, path)
    days = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith("run_date=")]
    newest = max(days, key=lambda p: p.getName(), default=None)
    return sum(s.getPath().getName().endswith(".parquet") for s in fs.listStatus(newest)) if newest else 0


def append_new_stats(stats: DataFrame, path: str) -> None:
    """Append the rows whose run, stage and file are not recorded yet, so a repeated step adds nothing."""
    spark, keys = stats.sparkSession, ["run_id", "stage_name", "source_filename"]
    append_stats(absent_rows(as_stats(stats), read_stats(spark, path), keys), path)


def append_records(spark: SparkSession, records: list[dict], path: str) -> None:
    if records:
        append_stats(stats_rows(spark, records).coalesce(1), path)


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """All statistics; an absent table reads as empty."""
    if not has_data(spark, path):
        return spark.createDataFrame([], STATS_SCHEMA)
    return as_stats(spark.read.schema(STATS_SCHEMA).parquet(path))


def hand_over(stats: DataFrame, path: str) -> None:
    """Write a stage's statistics as JSON lines for the next stage."""
    to_json_rows(as_stats(stats)).write.mode("overwrite").text(path)


def take_over(spark: SparkSession, path: str) -> DataFrame:
    """Statistics handed over by an earlier stage; none if there was no hand-over."""
    if not has_data(spark, path):
        return spark.createDataFrame([], STATS_SCHEMA)
    return from_json_rows(spark.read.text(path).withColumnRenamed("value", "json"))
