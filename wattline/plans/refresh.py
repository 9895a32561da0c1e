"""The whole run: files to clean Parquet, clean Parquet to the fact table, fact table to reports."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from time import monotonic

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.operators import checks, reports, stats
from wattline.operators.consumption import consumption_of_totals, daily_usage_of_days, meter_days, totals_of_days
from wattline.operators.loading import DAY, LoadCounts, insert_if_absent, new_pairs, readings_of_changed_meters, upsert
from wattline.operators.nearest import nearest_location
from wattline.operators.periods import attach_periods, schedule_repeats
from wattline.operators.quality import quality_of_days
from wattline.operators.staging import exclude_dates, fact_days, stage_keyed, stage_schedule, stage_sites, unkeyed_of_days
from wattline.operators.violations import regional_consumption, regional_violators, violators
from wattline.sources.buckets import BucketedTable
from wattline.sources.delimited import Resolver, count_rows, list_files, read_readings
from wattline.sources.facts import FactTable, day_files
from wattline.sources.runlog import append_new_stats, append_records, append_stats, hand_over, read_stats, take_over
from wattline.sources.scratch import scratch_area, written
from wattline.sources.tables import (
    EmptyOutput,
    VersionedTable,
    delete_path,
    has_data,
    publish,
    read_quarters,
    recover,
    replace_table,
    write_by_day,
    write_quarters,
)
from wattline.spec import PRESET, ModelSpec, OutlierSpec


@dataclass(frozen=True)
class Run:
    run_id: str
    run_timestamp: datetime


@dataclass(frozen=True)
class Places:
    """Folders of one installation, all below ``root``."""

    root: str

    def clean(self, run: Run) -> str:
        return f"{self.root}/clean/{run.run_id}"

    def building(self, run: Run) -> str:
        return f"{self.root}/clean/_building/{run.run_id}"

    def handed_over(self, run: Run) -> str:
        return f"{self.root}/etl_stats/{run.run_id}"

    @property
    def readings(self) -> str:
        return f"{self.root}/readings"

    @property
    def stats(self) -> str:
        return f"{self.root}/pipeline_stats"

    def model(self, name: str) -> str:
        return f"{self.root}/models/{name}"


def files_to_clean(
    spark: SparkSession,
    raw_folder: str,
    places: Places,
    run: Run,
    *,
    resolver: Resolver | None = None,
    on_reject: str = "fail",
    recursive: bool = False,
    pattern: str = "*.csv",
    with_hash: bool = True,
    compression: str = "snappy",
    row_group_bytes: int | None = None,
    max_rejected: float = 1.0,
) -> int:
    """All CSV files of a folder (by default those named so) to clean Parquet by quarter, in one job; returns rows written.

    No file is a clean no-op. The output is written aside and put in its place only when it passes the gates: a run that
    reads files but keeps no row, or rejects more than a share of ``max_rejected`` of all lines, fails and leaves what an
    earlier run of this id had written. Lines with more fields than their header are rejected; the same job writes them to a
    folder of their own, so the lines of each file are counted without reading it again. With
    ``on_reject="skip"`` the files turned away appear in the statistics with their problem.
    """
    started = monotonic()
    files = list_files(spark, raw_folder, pattern, recursive)
    if files.isEmpty():
        return 0
    with scratch_area(spark):
        clean, mapped = read_readings(spark, files, resolver=resolver, on_reject=on_reject, with_hash=with_hash, with_rejects=True)
        mapped = written(mapped, "mapped")
        place, aside = places.clean(run), places.building(run)
        try:
            write_quarters(clean, aside, compression, row_group_bytes)
            if not has_data(spark, aside):
                raise EmptyOutput(f"no rows written from {raw_folder}")
            back = read_quarters(spark, aside, rejects=True)
            lines = written(count_rows(back), "lines")
            read, kept = lines.agg(F.coalesce(F.sum("rows_input"), F.lit(0)), F.coalesce(F.sum("rows_kept"), F.lit(0))).first()
            if not kept:
                raise EmptyOutput(f"no rows written from {raw_folder}")
            if read - kept > max_rejected * read:
                raise checks.CheckFailed(f"{read - kept} of {read} lines of {raw_folder} have more fields than their header")
            publish(spark, aside, place)
        except Exception:
            delete_path(spark, aside)
            raise
        inputs = files.join(mapped.select("path", "problem"), "path", "left").join(lines.drop("rows_kept"), "path", "left")
        rows = stats.file_stats(read_quarters(spark, place), inputs, run.run_id, run.run_timestamp, monotonic() - started)
        hand_over(rows, places.handed_over(run))
    return take_over(spark, places.handed_over(run)).agg(F.sum("rows_output")).first()[0]


def clean_to_readings(spark: SparkSession, places: Places, run: Run, keys: list[str] | None = None) -> LoadCounts:
    """Add this run's clean rows to the fact table unless their key (the row hash, or ``keys``) is there; record
    statistics."""
    started = monotonic()
    record = {
        "run_id": run.run_id,
        "run_timestamp": run.run_timestamp,
        "source_filename": "all_files",
        "stage_name": "upload",
    }
    append_new_stats(take_over(spark, places.handed_over(run)), places.stats)
    try:
        recover(spark, places.clean(run))
        batch = read_quarters(spark, places.clean(run))
        counts = insert_if_absent(spark, batch, places.readings, keys)
    except Exception as error:
        failure = {"status": "failed", "error_message": str(error), "processing_seconds": monotonic() - started}
        append_records(spark, [{**record, **failure}], places.stats)
        raise
    success = {
        "rows_input": counts.rows_input,
        "rows_output": counts.rows_inserted,
        "rows_filtered": counts.rows_skipped,
        "rows_duplicates_skipped": counts.rows_skipped,
        "filter_reason": "duplicate_row_hash" if counts.rows_skipped else None,
        "processing_seconds": monotonic() - started,
    }
    append_records(spark, [{**record, **success}], places.stats)
    return counts


def _day_marks(spark: SparkSession, path: str) -> DataFrame:
    """Per day of a table by day a hash of the set of its files, from the listing alone."""
    one = F.xxhash64("path", "length", F.col("modificationTime").cast("string"))
    return day_files(spark, path, DAY).groupBy(DAY).agg(F.hash(F.sort_array(F.collect_list(one))).alias("files"))


def refresh_days(
    source: DataFrame,
    source_path: str,
    build: Callable[[DataFrame], DataFrame],
    path: str,
    marks_path: str,
    context: str,
    cluster_by: list[str],
    full_refresh: bool = False,
) -> DataFrame:
    """A table by day built from a table by day (``source``, read from ``source_path``), where only days whose source changed are read
    and built again.

    A day is unchanged when its source consists of the same files (path, size and time of writing, as the listing tells them) and the
    table was built in the same ``context``; both are recorded after the days are written, so a run that fails before builds
    them again. A full rebuild forgets the record first: if it fails, the next run rebuilds everything.
    """
    spark = source.sparkSession
    marks = VersionedTable(spark, marks_path)
    days = written(_day_marks(spark, source_path).withColumn("context", F.lit(context)), "days")
    todo, only_its_days = source, False
    known = marks.read() if marks.exists() and not full_refresh else None
    if known is not None and known.where(F.col("context") == context).isEmpty():
        known = None  # built in another context, or nothing built
    if known is None:
        marks.clear()
    else:
        old = known.select(F.col(DAY).alias("day"), F.col("files").alias("known_files"))
        changed = days.join(old, F.col(DAY).eqNullSafe(F.col("day")) & (F.col("files") == F.col("known_files")), "left_anti")
        # one short row per calendar day
        listed = [row[0] for row in changed.select(DAY).collect()]
        dated = [d for d in listed if d is not None]
        wanted = F.col(DAY).isin(dated) if dated else F.lit(False)
        todo, only_its_days = source.where(wanted | F.col(DAY).isNull() if len(dated) < len(listed) else wanted), True
    built = build(todo)
    write_by_day(built, path, DAY, cluster_by, mode="overwrite", only_its_days=only_its_days)
    marks.replace(days)
    marks.drop_old(keep=2)
    return spark.read.schema(built.schema).parquet(path).select(*built.columns)


def refresh_staged(
    spark: SparkSession, fact: DataFrame, places: Places, spec: OutlierSpec = PRESET.outliers, full_refresh: bool = False
) -> DataFrame:
    """Staged readings as a table by day (see ``refresh_days``). A reading's key contains its time, so copies never
    cross days. The one row for readings without a full key is kept apart."""
    keyed, unkeyed, *_ = _refresh_staged(fact, places, spec, full_refresh)
    return keyed.unionByName(unkeyed)


def _refresh_staged(
    fact: DataFrame, places: Places, spec: OutlierSpec, full_refresh: bool
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Staged rows with a full key, the one without, and per day of the facts its counts and the state of its checks."""
    context = f"{spec.low} {spec.high}"

    def refreshed(build: Callable[[DataFrame], DataFrame], name: str, marks: str, cluster_by: list[str]) -> DataFrame:
        return refresh_days(fact, places.readings, build, places.model(name), places.model(marks), context, cluster_by, full_refresh)

    keyed = refreshed(lambda rows: stage_keyed(rows, spec), "staged_readings", "staged_days", ["meter_id", "reading_at"])
    days = refreshed(lambda rows: fact_days(rows, DAY, spec), "fact_days", "fact_days_built", [])
    checked = refreshed(lambda rows: checks.fact_checks(rows, DAY), "fact_checks", "fact_checks_built", [])
    return keyed, replace_table(unkeyed_of_days(days), places.model("staged_without_key")), days, checked


def _content(df: DataFrame) -> str:
    """A hash of a small table's rows, in any order."""
    one = F.xxhash64(*df.columns)
    return str(tuple(df.agg(F.count("*"), F.sum(one % (1 << 40)), F.bit_xor(one)).first()))


def readings_to_models(
    spark: SparkSession,
    places: Places,
    run: Run,
    schedule: DataFrame,
    sites: DataFrame,
    spec: ModelSpec = PRESET,
    full_refresh: bool = False,
) -> dict[str, DataFrame]:
    """Build all models from the fact table.

    Staged readings are written by day, and so is a table of additive totals per meter and day, which alone is read by
    every model after that. Both are built again for changed days only (the second one wholly when locations,
    schedule or periods change), so a run reads the facts of changed days and otherwise small tables. Daily usage is a
    view of the second. Consumption recomputes only meters with newer readings, and
    recorded (meter, quarter) pairs of violators stay as they are, unless ``full_refresh``.
    """
    with scratch_area(spark):
        return _build_models(spark, places, run, schedule, sites, spec, full_refresh)


def _build_models(
    spark: SparkSession,
    places: Places,
    run: Run,
    schedule: DataFrame,
    sites: DataFrame,
    spec: ModelSpec,
    full_refresh: bool,
) -> dict[str, DataFrame]:
    keyed, unkeyed, loaded, checked = _refresh_staged(FactTable(spark, places.readings, DAY).read(), places, spec.outliers, full_refresh)
    calendar = replace_table(stage_schedule(schedule), places.model("staged_schedule"))
    # two schedule rows for a calendar day of a location would double its readings
    checks.require_none(schedule_repeats(calendar), "schedule days repeat")
    site_rows = replace_table(stage_sites(sites), places.model("staged_sites"))
    locations = replace_table(nearest_location(site_rows, calendar), places.model("meter_locations"))

    def totals(rows: DataFrame) -> DataFrame:
        return meter_days(attach_periods(rows, locations, calendar, spec.periods), spec.periods)

    context = f"{_content(locations)} {_content(calendar)} {spec.periods} {spec.outliers}"
    dated = refresh_days(keyed, places.model("staged_readings"), totals, places.model("meter_days"), places.model("meter_days_built"), context, ["meter_id"], full_refresh)
    all_days = dated.unionByName(replace_table(totals(unkeyed), places.model("days_without_key")))
    days = exclude_dates(all_days, spec.exclude)
    quality = replace_table(quality_of_days(days, spec.quality), places.model("meter_quality"))
    daily = daily_usage_of_days(days)

    consumed = BucketedTable(spark, places.model("consumption_analysis"), ["meter_id"])
    incremental = consumed.exists() and not full_refresh
    todo = readings_of_changed_meters(days, consumed.read(), spread="reading_date") if incremental else days
    fresh = consumption_of_totals(totals_of_days(todo), locations, spec.energy)
    usage = upsert(consumed, fresh, ["meter_id"]) if incremental else consumed.replace(fresh)
    checks.require_none(checks.duplicate_keys(usage, ["meter_id"]), "meter_id repeats in consumption")

    flagged = BucketedTable(spark, places.model("violators"), ["meter_id", "quarter"])
    if flagged.exists() and not full_refresh:
        found = violators(new_pairs(usage, flagged.read()), quality, spec.threshold, spec.energy)
        over = upsert(flagged, found, ["meter_id", "quarter"])
    else:
        over = flagged.replace(violators(usage, quality, spec.threshold, spec.energy))

    tested = replace_table(checks.run_checks(checked, usage, daily), places.model("table_checks"))

    # the version before stays for readers that are still on it
    consumed.drop_old(keep=2)
    flagged.drop_old(keep=2)

    regional = replace_table(
        regional_consumption(usage, quality, spec.region, spec.threshold), places.model("consumption_riyadh")
    )
    regional_over = replace_table(regional_violators(regional), places.model("violators_riyadh"))
    report = replace_table(
        reports.regional_report(regional, quality, locations, spec.region, spec.comparison),
        places.model("riyadh_quarter_report"),
    )

    stages = {
        "staging": stats.staging_stats(loaded, all_days, run.run_id, run.run_timestamp),
        "ramadan_filter": stats.exclusion_stats(all_days, spec.exclude, run.run_id, run.run_timestamp),
    }
    for stage, rows in stages.items():
        recorded = read_stats(spark, places.stats).where(F.col("stage_name") == stage)
        append_stats(stats.not_yet_run(rows, recorded), places.stats)

    return {
        "staged_readings": keyed.unionByName(unkeyed),
        "meter_days": all_days,
        "meter_locations": locations,
        "meter_quality": quality,
        "daily_usage": daily,
        "consumption_analysis": usage,
        "violators": over,
        "consumption_riyadh": regional,
        "violators_riyadh": regional_over,
        "riyadh_quarter_report": report,
        "table_checks": tested,
    }


def name_models(models: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Make the models of a run views of the session under their names, for queries in SQL; a later run's take their place. Daily
    usage is not kept as a table: it is computed from the meters' days whenever it is read."""
    names = [f"{prefix}{name}" for name in models]
    for name, rows in zip(names, models.values()):
        rows.createOrReplaceTempView(name)
    return names
