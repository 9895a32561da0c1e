"""The registered queries: (spark, folder of the given tables) to a result frame."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import fixtures
from wattline.functions import floor_minute, half_up, parse_reading_time, quarter_label, row_hash, safe_double, time_text
from wattline.operators import checks, loading, reports, stats
from wattline.operators.consumption import consumption, daily_usage
from wattline.operators.nearest import nearest_location
from wattline.operators.periods import attach_periods, in_evening, in_morning, schedule_repeats
from wattline.operators.quality import meter_quality
from wattline.operators.staging import (
    exclude_dates,
    keep_first,
    mask_outliers,
    stage_readings,
    stage_schedule,
    stage_sites,
)
from wattline.operators.violations import flag_over, regional_consumption, regional_violators, violation_category, violators, with_quality
from wattline.plans.refresh import Places, Run, clean_to_readings, files_to_clean, name_models, readings_to_models
from wattline.sources.buckets import BucketedTable
from wattline.sources.delimited import count_rows, list_files, map_headers, read_layouts, read_readings, sniff_headers
from wattline.sources.facts import FactTable
from wattline.sources.reference import load_reference
from wattline.sources.runlog import append_new_stats, hand_over, read_stats, take_over
from wattline.sources.scratch import scratch_path, written
from wattline.sources.tables import EmptyOutput, VersionedTable, read_quarters, read_table, write_by_day
from wattline.spec import READING_COLUMNS, ModelSpec, QualitySpec, RegionSpec
from wattline.streaming.arrivals import arriving_files, start_loading

EXCLUDE = (date(2024, 1, 10), date(2024, 1, 15))
SPEC = ModelSpec(quality=QualitySpec(per_day=4), region=RegionSpec("ASIA", "%NATION_1%"))
RUN = Run("run_1", datetime(2024, 2, 1))
LAST_DAY = date(2024, 1, 30)
MIDDLE = date(2024, 1, 20)


# ---- inputs ---------------------------------------------------------------


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fixture(spark: SparkSession, folder: str, text: str) -> DataFrame:
    names = ["events", "customer", "nation", "region", "orders"]
    used = {n: table(spark, folder, n) for n in names if "{" + n + "}" in text}
    return spark.sql(text, **used)


def raw_readings(spark, folder):
    return fixture(spark, folder, fixtures.READINGS)


def clean(spark, folder):
    """The readings at whole minutes, as a clean fact table holds them."""
    return raw_readings(spark, folder).withColumn("data_time", floor_minute(F.col("data_time")))


def staged(spark, folder):
    return stage_readings(clean(spark, folder))


def site_rows(spark, folder):
    return fixture(spark, folder, fixtures.SITES).select(
        F.col("meter_number").alias("Meter Number"),
        F.col("factor_text").alias("Multiplication Factor"),
        F.col("x_text").alias("X Coordinates"),
        F.col("y_text").alias("Y Coordinates"),
        F.col("region").alias("Region"),
        F.col("province").alias("Province"),
        F.col("department").alias("Department Name"),
        F.col("office").alias("Office Name"),
    )


def schedule_rows(spark, folder):
    return fixture(spark, folder, fixtures.SCHEDULE).select(
        F.col("coordinate").alias("Coordinate"),
        F.col("date_text").alias("Date"),
        F.col("fajr").alias("Fajr"),
        F.col("dhuhr").alias("Dhuhr"),
        F.lit("15:30").alias("Asr"),
        F.lit("18:05").alias("Maghrib"),
        F.col("isha").alias("Isha"),
    )


def sites(spark, folder):
    return stage_sites(site_rows(spark, folder))


def schedule(spark, folder):
    """Staged schedule, written once: several steps read it."""
    return written(stage_schedule(schedule_rows(spark, folder)), "schedule")


def locations(spark, folder, calendar=None):
    return written(nearest_location(sites(spark, folder), calendar or schedule(spark, folder)), "locations")


def periods(spark, folder, readings=None, places=None, calendar=None):
    calendar = calendar or schedule(spark, folder)
    places = places or locations(spark, folder, calendar)
    return attach_periods(readings or staged(spark, folder), places, calendar)


def usage(spark, folder, readings=None):
    calendar = schedule(spark, folder)
    places = locations(spark, folder, calendar)
    return consumption(periods(spark, folder, readings, places, calendar), places)


def quality(spark, folder):
    return meter_quality(staged(spark, folder), SPEC.quality)


def regional(spark, folder):
    return regional_consumption(usage(spark, folder), quality(spark, folder), SPEC.region)


# ---- staging --------------------------------------------------------------


def dedup_latest(spark, folder):
    power = F.col("import_active_power").desc_nulls_last()
    return keep_first(clean(spark, folder), ["meter_id", "data_time"], [power, F.col("src_id")])


def outlier_mask(spark, folder):
    masked = mask_outliers(F.col("import_active_power")).alias("active_power_watts")
    return raw_readings(spark, folder).select("src_id", masked)


def exclude_dates_query(spark, folder):
    return exclude_dates(staged(spark, folder), EXCLUDE)


def parse_timestamps(spark, folder):
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    text = (
        F.when(F.col("event_type") == "view", F.concat(ts, F.lit(".4600000")))
        .when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd"))
        .when(F.col("event_type") == "purchase", F.date_format("ts", "dd/MM/yyyy HH:mm"))
        .otherwise(ts)
    )
    power = F.when(F.col("event_type") == "click", F.lit("n/a")).otherwise(
        F.concat(F.lit("  "), F.col("value").cast("string"), F.lit(" "))
    )
    parsed = parse_reading_time(F.col("text"))
    return (
        table(spark, folder, "events")
        .select("event_id", text.alias("text"), power.alias("power_text"))
        .select(
            "event_id",
            "text",
            parsed.alias("data_time"),
            time_text(parsed).alias("data_time_str"),
            quarter_label(parsed).alias("quarter"),
            safe_double(F.col("power_text")).alias("power"),
        )
    )


def row_key(spark, folder):
    """Groups by row hash; their members show that equal hash means equal meter and minute."""
    key = row_hash(F.col("meter_id"), time_text(F.col("data_time")))
    return (
        clean(spark, folder)
        .groupBy(key.alias("key"))
        .agg(
            F.min("meter_id").alias("meter_id"),
            F.max("meter_id").alias("other_meter_id"),
            F.min("data_time").alias("data_time"),
            F.max("data_time").alias("other_data_time"),
            F.count("*").alias("n"),
        )
        .drop("key")
    )


def staging_stats_query(spark, folder):
    source = clean(spark, folder)
    return stats.staging_stats(source, stage_readings(source), RUN.run_id, RUN.run_timestamp)


def exclusion_stats_query(spark, folder):
    return stats.exclusion_stats(staged(spark, folder), EXCLUDE, RUN.run_id, RUN.run_timestamp)


# ---- locations and periods ------------------------------------------------


def _rounded(df):
    return df.withColumn("distance_meters", half_up(F.col("distance_meters"), 0))


def nearest_query(spark, folder):
    return _rounded(nearest_location(sites(spark, folder), schedule(spark, folder)))


def nearest_by_cells(spark, folder):
    return _rounded(nearest_location(sites(spark, folder), schedule(spark, folder), max_inline_locations=0))


def attach_periods_salted(spark, folder):
    calendar = schedule(spark, folder)
    return attach_periods(staged(spark, folder), locations(spark, folder, calendar), calendar, max_broadcast_bytes=0)


def period_flags(spark, folder):
    return periods(spark, folder).select(
        "meter_id",
        "reading_at",
        F.coalesce(in_morning(), F.lit(False)).alias("in_morning"),
        F.coalesce(in_evening(), F.lit(False)).alias("in_evening"),
    )


def schedule_repeats_query(spark, folder):
    return schedule_repeats(fixture(spark, folder, fixtures.YEARS)).withColumnRenamed("count", "n")


# ---- marts ----------------------------------------------------------------


def consumption_excluding(spark, folder):
    return usage(spark, folder, exclude_dates(staged(spark, folder), EXCLUDE))


def flag_over_query(spark, folder):
    flagged = flag_over(with_quality(usage(spark, folder), quality(spark, folder)))
    return flagged.select(
        "meter_id",
        "morning_avg_mf",
        "evening_avg_mf",
        "over_in_morning",
        "over_in_evening",
        "over_in_both",
        "over_in_either",
        violation_category().alias("violation_category"),
    )


def violators_query(spark, folder):
    return violators(usage(spark, folder), quality(spark, folder))


def regional_violators_query(spark, folder):
    return regional_violators(written(regional(spark, folder), "regional"))


def regional_report_query(spark, folder):
    calendar = schedule(spark, folder)
    places = locations(spark, folder, calendar)
    scores = written(quality(spark, folder), "quality")
    used = consumption(periods(spark, folder, None, places, calendar), places)
    region = regional_consumption(used, scores, SPEC.region)
    return reports.regional_report(region, scores, places, SPEC.region)


# ---- incremental ----------------------------------------------------------


def _before(df, day, column="data_time"):
    return df.where(F.to_date(column) < F.lit(day))


def _from(df, day, column="data_time"):
    return df.where(F.to_date(column) >= F.lit(day))


def insert_if_absent_query(spark, folder):
    """First the readings before the 20th, then all readings: only unseen keys are added."""
    path = scratch_path(spark, "inserted")
    rows = clean(spark, folder)
    loading.insert_if_absent(spark, _before(rows, MIDDLE), path, ["meter_id", "data_time"], "data_time")
    loading.insert_if_absent(spark, rows, path, ["meter_id", "data_time"], "data_time")
    return FactTable(spark, path).read().select("meter_id", "data_time", "import_active_power", "src_id", "reading_date")


def insert_if_absent_hash(spark, folder):
    """Three loads by the default key, the first of a part, of readings some of which lack meter or time: in
    the end every reading is there as often as in one load."""
    path = scratch_path(spark, "hashed")
    rows = clean(spark, folder).select(
        F.when(F.col("src_id") % 50 != 0, F.col("meter_id")).alias("METER_ID"),
        F.when(F.col("src_id") % 70 != 0, F.col("data_time")).alias("DATA_TIME"),
        F.col("import_active_power").alias("IMPORT_ACTIVE_POWER"),
        "src_id",
    )
    rows = rows.withColumn("ROW_HASH", row_hash(F.col("METER_ID"), time_text(F.col("DATA_TIME"))))
    loading.insert_if_absent(spark, rows.where(F.col("DATA_TIME").isNull() | (F.to_date("DATA_TIME") < F.lit(MIDDLE))), path)
    loading.insert_if_absent(spark, rows, path)
    loading.insert_if_absent(spark, rows, path)
    return FactTable(spark, path).read().drop("ROW_HASH")


def upsert_by_key(spark, folder):
    """Per-meter totals before the 15th, then totals of the rest with one more column."""
    events = table(spark, folder, "events").withColumn("meter_id", F.col("user_id").cast("string"))
    day = date(2024, 1, 29)
    old = _before(events, day, "ts").groupBy("meter_id").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"))
    new = _from(events, day, "ts").groupBy("meter_id").agg(
        F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("value").alias("max_value")
    )
    target = BucketedTable(spark, scratch_path(spark, "upserted"), ["meter_id"])
    loading.upsert(target, old, ["meter_id"])
    return loading.upsert(target, new, ["meter_id"])


def changed_meters_query(spark, folder):
    readings = staged(spark, folder)
    covered = _before(readings, LAST_DAY, "reading_date").groupBy("meter_id").agg(F.max("reading_date").alias("max_reading_date"))
    return loading.changed_meters(readings, covered)


def readings_of_changed(spark, folder):
    readings = staged(spark, folder)
    covered = _before(readings, LAST_DAY, "reading_date").groupBy("meter_id").agg(F.max("reading_date").alias("max_reading_date"))
    return loading.readings_of_changed_meters(readings, covered, max_broadcast_bytes=0)


def new_pairs_query(spark, folder):
    """Meters and quarters not recorded when only orders of the first years were known."""
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("meter_id"), quarter_label(F.col("o_orderdate")).alias("quarter"), "o_totalprice", "o_orderpriority"
    )
    all_pairs = orders.groupBy("meter_id", "quarter").agg(F.count("*").alias("n"))
    urgent = orders.where("o_orderpriority = '1-URGENT'").select("meter_id", "quarter").distinct()
    return loading.new_pairs(all_pairs, urgent)


def incremental_consumption(spark, folder):
    """Consumption built without the last day, then again with it: meters without a newer reading
    keep their rows, the others are recomputed from all their readings."""
    calendar = schedule(spark, folder)
    places = locations(spark, folder, calendar)
    readings = written(staged(spark, folder), "staged")
    target = VersionedTable(spark, scratch_path(spark, "consumption"))

    def build(rows):
        return consumption(attach_periods(rows, places, calendar), places)

    loading.upsert(target, build(_before(readings, LAST_DAY, "reading_date")), ["meter_id"])
    todo = loading.readings_of_changed_meters(readings, target.read())
    return loading.upsert(target, build(todo), ["meter_id"])


# ---- statistics and checks ------------------------------------------------


def daily_runs(spark, folder):
    """Statistics of one staging run per day of the readings."""
    rows_in = clean(spark, folder).groupBy(F.to_date("data_time").alias("day")).agg(F.count("*").alias("rows_input"))
    rows_out = staged(spark, folder).groupBy(F.col("reading_date").alias("day")).agg(
        F.count("*").alias("rows_output"),
        F.countDistinct("meter_id").alias("unique_meters"),
        F.min("reading_date").alias("min_reading_date"),
        F.max("reading_date").alias("max_reading_date"),
    )
    return stats.as_stats(
        rows_in.join(rows_out, "day").select(
            "*",
            F.concat(F.lit("run_"), F.date_format("day", "yyyyMMdd")).alias("run_id"),
            F.col("day").cast("timestamp_ntz").alias("run_timestamp"),
            F.lit("all_files").alias("source_filename"),
            F.lit("staging").alias("stage_name"),
            (F.col("rows_input") - F.col("rows_output")).alias("rows_filtered"),
            F.lit("success").alias("status"),
        )
    )


def run_not_in(spark, folder):
    runs = daily_runs(spark, folder)
    return stats.not_yet_run(runs, runs.where(F.col("run_timestamp") < F.lit(MIDDLE)))


def run_not_in_null(spark, folder):
    """A recorded null id blocks every row."""
    runs = daily_runs(spark, folder)
    late = F.col("run_timestamp") >= F.lit(MIDDLE)
    recorded = runs.withColumn("run_id", F.when(late, F.col("run_id")))
    return stats.not_yet_run(runs, recorded)


def stats_json(spark, folder):
    return stats.from_json_rows(stats.to_json_rows(daily_runs(spark, folder)))


def file_profile(spark, folder):
    """Statistics per file when readings come in one file per event type."""
    events = table(spark, folder, "events")
    name = F.concat("event_type", F.lit(".csv")).alias("source_filename")
    rows = events.select(
        name,
        F.col("user_id").cast("string").alias("METER_ID"),
        floor_minute(F.col("ts")).alias("DATA_TIME"),
        F.when(F.col("value") <= 200, F.col("value")).alias("IMPORT_ACTIVE_POWER"),
    )
    inputs = events.groupBy(name).agg(
        F.count("*").alias("rows_input"), F.sum(F.length("props")).alias("file_size_bytes")
    )
    return stats.file_stats(rows, inputs, RUN.run_id, RUN.run_timestamp)


def stats_table(spark, folder):
    """Statistics handed over as JSON, taken over, appended by day of the run, twice, and read back."""
    runs, place, path = daily_runs(spark, folder), scratch_path(spark, "handed"), scratch_path(spark, "stats")
    hand_over(runs, place)
    for _ in range(2):
        append_new_stats(take_over(spark, place), path)
    return read_stats(spark, path)


def reference_load(spark, folder):
    """The site sheet from CSV under normal names, with inferred types and a load time."""
    sheet, path = scratch_path(spark, "sheet"), scratch_path(spark, "reference")
    writer = site_rows(spark, folder).write.option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(sheet)
    load_reference(spark, sheet, path)
    loaded = read_table(spark, path)
    return loaded.select(
        *[F.col(c) for c in loaded.columns if c != "_LOADED_AT"], F.col("_LOADED_AT").isNotNull().alias("HAS_LOAD_TIME")
    )


def load_counts(spark, folder):
    """What three loads report: a part, everything, and a batch without its key column."""
    path = scratch_path(spark, "counted")
    rows = clean(spark, folder).withColumn("ROW_HASH", row_hash(F.col("meter_id"), time_text(F.col("data_time"))))
    loads = [_before(rows, MIDDLE), rows, rows.drop("ROW_HASH")]
    counts = [loading.insert_if_absent(spark, batch, path, time="data_time") for batch in loads]
    reported = [(i, c.rows_input, c.rows_inserted, c.rows_skipped) for i, c in enumerate(counts)]
    told = spark.createDataFrame(reported, "load int, rows_input long, rows_inserted long, rows_skipped long")
    there = FactTable(spark, path).read().agg(F.count("*").alias("rows_in_table"), F.count("ROW_HASH").alias("rows_with_key"))
    return told.crossJoin(F.broadcast(there))  # three rows and one


def proposed_mapping(spark, folder):
    """Files with unknown headers, mapped by proposals that misspell names, lack some, or name some twice."""
    root = scratch_path(spark, "proposed")
    rows = raw_readings(spark, folder).select("meter_id", F.date_format("data_time", "yyyy-MM-dd").alias("d"), "import_active_power")
    for number in range(3):
        rows.toDF("Serial", "When", "Load").write.option("header", True).csv(f"{root}/case={number}")
    sniffed = written(sniff_headers(list_files(spark, root, recursive=True)), "sniffed")
    case = F.regexp_extract("path", r"case=(\d)", 1).cast("int")
    pairs = [
        [("SERIAL", "METER_ID"), ("When", "DATA_TIME"), ("load ", "IMPORT_ACTIVE_POWER"), ("Ghost", "STATUS")],
        [("When", "DATA_TIME")],
        [("When", "DATA_TIME"), ("Load", "DATA_TIME")],
    ]
    wanted = spark.createDataFrame([(i, a, b) for i, p in enumerate(pairs) for a, b in p], "number int, incoming string, target string")
    proposals = sniffed.select("path", case.alias("number")).join(wanted, "number").drop("number")
    mapped = map_headers(sniffed, proposals)
    found = mapped.select(
        "path", case.alias("case"), "kind", "problem", F.col("mapping")["METER_ID"].alias("meter_position"), F.col("mapping")["IMPORT_ACTIVE_POWER"].alias("power_position")
    )
    counted = found.join(count_rows(read_layouts(spark, mapped)), "path", "left")
    return counted.groupBy("case", "kind", "problem", "meter_position", "power_position").agg(F.sum("rows_input").alias("n_rows"))


def unhashed_run(spark, folder):
    """A run without row hashes under other writer settings: the clean table's rows."""
    places, raw = Places(scratch_path(spark, "run")), scratch_path(spark, "raw")
    _as_text(raw_readings(spark, folder)).write.option("header", True).csv(raw)
    files_to_clean(spark, raw, places, RUN, with_hash=False, compression="zstd", row_group_bytes=1 << 20)
    return read_quarters(spark, places.clean(RUN)).drop("source_filename")


def unique_check(spark, folder):
    return checks.duplicate_keys(clean(spark, folder), ["meter_id", "data_time"])


def not_null_check(spark, folder):
    return checks.null_counts(clean(spark, folder), ["meter_id", "data_time", "import_active_power"])


def table_checks_broken(spark, folder):
    """The standing checks on tables with faults put in: missing hashes, repeated meters, repeated and undated days."""
    rows = clean(spark, folder)
    missing = F.col("src_id") % 100 == 0
    keyed = rows.withColumn("ROW_HASH", F.when(~missing, row_hash(F.col("meter_id"), time_text(F.col("data_time")))))
    used = written(usage(spark, folder), "usage")
    used = used.unionByName(used.where("meter_id like '1%'"))
    daily = written(daily_usage(staged(spark, folder)), "daily")
    daily = daily.unionByName(daily.where("day(date) = 3")).withColumn("date", F.when(F.dayofmonth("date") != 5, F.col("date")))
    return checks.table_checks(keyed, used, daily)


def table_checks(spark, folder):
    rows = clean(spark, folder)
    keyed = rows.withColumn("ROW_HASH", row_hash(F.col("meter_id"), time_text(F.col("data_time"))))
    daily = written(daily_usage(staged(spark, folder)), "daily")
    return checks.table_checks(keyed, written(usage(spark, folder), "usage"), daily)


# ---- files ----------------------------------------------------------------

# separator and header names of the written layouts; the first is the whole expected list
LAYOUTS = [
    (",", [c.lower() for c in READING_COLUMNS]),
    (";", ["Reading_DateTime", "MTR_ID", "note", "ACTIVE_POWER"]),
    ("\t", ["METER", "IMPORT_POWER", "TIMESTAMP"]),
    ("|", ["STATUS", "DT", "METERID", "KW_IMP"]),
    # an unnamed index column and a name that holds the separator; an unnamed column inside and one at the end
    (",", ["", "METER_ID", "note, free", "DATA_TIME", "IMPORT_ACTIVE_POWER"]),
    (";", ["METER_ID", "", "DATA_TIME", "IMPORT_ACTIVE_POWER", ""]),
]


LAYOUT_FILES = "part-*.{csv,txt}"


def write_layouts(spark, folder) -> str:
    """The readings written as CSV once per layout, with differing ids, headers and separators."""
    root = scratch_path(spark, "csv")
    rows = raw_readings(spark, folder).select(
        F.concat(F.lit("00"), "meter_id").alias("id"),
        F.concat(F.date_format("data_time", "yyyy-MM-dd HH:mm:ss"), F.lit(".4600000")).alias("time"),
        F.concat(F.lit(" "), F.col("import_active_power").cast("string")).alias("power"),
    )
    for number, (sep, headers) in enumerate(LAYOUTS):
        def value(header):
            name = header.upper()
            if name in ("METER_ID", "MTR_ID", "METER", "METERID"):
                return F.col("id")
            if name in ("DATA_TIME", "READING_DATETIME", "TIMESTAMP", "DT"):
                return F.col("time")
            if name in ("IMPORT_ACTIVE_POWER", "ACTIVE_POWER", "IMPORT_POWER", "KW_IMP"):
                return F.col("power")
            return F.lit(f"a{sep}b") if name else F.lit("5")

        if "" in headers:  # the CSV writer cannot write a column without a name: whole lines below one name, the header line
            quoted = [f'"{h}"' if sep in h else h for h in headers]
            cells = [F.concat(F.lit('"'), value(h), F.lit('"')) if sep in h else value(h) for h in headers]
            lines = rows.select(F.concat_ws(sep, *[F.coalesce(c, F.lit("")) for c in cells]).alias(sep.join(quoted)))
            writer = lines.write.option("header", True).option("sep", "\x01").option("quote", "")
            writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{root}/layout={number}")
            continue
        (
            rows.select(*[value(h).alias(h) for h in headers])
            .write.option("header", True)
            .option("sep", sep)
            .option("ignoreLeadingWhiteSpace", False)
            .csv(f"{root}/layout={number}")
        )
    return root


def csv_harmonised(spark, folder):
    files = list_files(spark, write_layouts(spark, folder), LAYOUT_FILES, recursive=True)
    rows, _ = read_readings(spark, files)
    return rows.select("METER_ID", "DATA_TIME", "IMPORT_ACTIVE_POWER", "DATA_TIME_STR", "QUARTER")


def header_mapping(spark, folder):
    """Per written layout: how its headers were mapped, and what was read through that mapping."""
    files = list_files(spark, write_layouts(spark, folder), LAYOUT_FILES, recursive=True)
    mapped = map_headers(sniff_headers(files))
    layout = F.regexp_extract("path", r"layout=(\d+)", 1).cast("int")
    found = mapped.select(
        "path",
        layout.alias("layout"),
        "separator",
        F.concat_ws(" ", "headers").alias("headers"),
        "kind",
        F.col("mapping")["METER_ID"].alias("meter_position"),
        F.col("mapping")["DATA_TIME"].alias("time_position"),
        F.col("mapping")["IMPORT_ACTIVE_POWER"].alias("power_position"),
    )
    names = [c for c in found.columns if c != "path"]
    rows = read_layouts(spark, mapped).withColumnRenamed("source_filename", "path").join(found, "path")
    return rows.groupBy(*names).agg(F.count("*").alias("n_rows"), F.countDistinct("METER_ID").alias("n_meters"))


def file_stats_run(spark, folder):
    """Statistics of a run over the written files and some whose headers are unknown, by outcome."""
    places, root = Places(scratch_path(spark, "run")), write_layouts(spark, folder)
    odd = raw_readings(spark, folder).select(F.col("meter_id").alias("Serial"), F.lit("x").alias("DATA_TIME"))
    odd.write.option("header", True).csv(f"{root}/layout=odd")
    files_to_clean(spark, root, places, RUN, on_reject="skip", recursive=True, pattern=LAYOUT_FILES)
    recorded = take_over(spark, places.handed_over(RUN))
    return recorded.groupBy("stage_name", "status", "error_message").agg(
        F.sum("rows_input").alias("rows_input"),
        F.sum("rows_output").alias("rows_output"),
        F.sum("rows_filtered").alias("rows_filtered"),
        F.min("min_reading_date").alias("min_reading_date"),
        F.max("max_reading_date").alias("max_reading_date"),
        F.sum("rows_with_null_power").alias("rows_with_null_power"),
        F.sum("rows_with_zero_power").alias("rows_with_zero_power"),
    )


def _write_broken(spark, folder, raw, broken):
    """The readings as lines whose note holds the separator: quoted as a rule, without quotes (a field too many) where ``broken``;
    every eleventh of the others lacks its last field."""
    rows = raw_readings(spark, folder).select(
        "src_id", "meter_id", F.date_format("data_time", "yyyy-MM-dd HH:mm:ss").alias("time"), F.col("import_active_power").cast("string").alias("power")
    )
    note = F.when(broken, F.lit("a;b")).otherwise(F.lit('"a;b"'))
    power = F.when(broken | (F.col("src_id") % 11 != 0), F.concat(F.lit(";"), F.coalesce("power", F.lit(""))))
    lines = rows.select(F.concat(F.concat_ws(";", note, "meter_id", "time"), F.coalesce(power, F.lit(""))).alias("value"))
    first = spark.createDataFrame([("note;METER_ID;DATA_TIME;IMPORT_ACTIVE_POWER",)], "value string")
    first.unionByName(lines).coalesce(1).write.option("compression", "none").text(raw)


def broken_lines_run(spark, folder):
    """Statistics of a run over a file some of whose lines have more fields than the header, or fewer."""
    places, raw = Places(scratch_path(spark, "run")), scratch_path(spark, "raw")
    _write_broken(spark, folder, raw, F.col("src_id") % 7 == 0)
    files_to_clean(spark, raw, places, RUN, pattern="*.txt")
    told = take_over(spark, places.handed_over(RUN))
    return told.select("status", "rows_input", "rows_output", "rows_filtered", "filter_reason", "unique_meters", "rows_with_null_power", "rows_with_zero_power")


def gated_run(spark, folder):
    """A run, then two of the same id that do not pass the gates (no line kept; too many lines broken): what readers find."""
    places = Places(scratch_path(spark, "run"))
    for broken, most, fails in ((F.col("src_id") % 7 == 0, 0.5, None), (F.lit(True), 1.0, EmptyOutput), (F.col("src_id") % 2 == 0, 0.2, checks.CheckFailed)):
        raw = scratch_path(spark, "raw")
        _write_broken(spark, folder, raw, broken)
        if fails is None:
            files_to_clean(spark, raw, places, RUN, pattern="*.txt", max_rejected=most)
            continue
        try:
            files_to_clean(spark, raw, places, RUN, pattern="*.txt", max_rejected=most)
        except fails:
            continue
        raise AssertionError("the gate let the run through")
    return read_quarters(spark, places.clean(RUN)).select("METER_ID", "DATA_TIME", "IMPORT_ACTIVE_POWER", "QUARTER")


def mixed_batches(spark, folder):
    """One fact table from batches of different columns: short ones, full ones with a status and a whole-number power, one without key."""
    path = scratch_path(spark, "mixed")
    rows = clean(spark, folder).select("meter_id", "data_time", "import_active_power", "src_id")
    # every source row has a key of its own, so that no batch's row counts as known by another's
    own = F.concat(time_text(F.col("data_time")), F.lit(" "), F.col("src_id").cast("string"))
    keyed = rows.withColumn("ROW_HASH", row_hash(F.col("meter_id"), own))
    part = F.col("src_id") % 4
    full = keyed.withColumn("status", F.when(part == 1, F.lit("ok"))).withColumn("src_id", F.col("src_id").cast("long"))
    loads = [
        keyed.where(part == 0),
        full.where(part == 1).withColumn("import_active_power", F.col("import_active_power").cast("int")),
        rows.where(part == 2),
        keyed.where(part == 3).withColumn("note", F.lit(7)).drop("import_active_power"),
        full.where(part == 1),  # all of it known
    ]
    for batch in loads:
        loading.insert_if_absent(spark, batch, path, time="data_time")
    found = FactTable(spark, path).read()
    return found.select(
        "src_id", "meter_id", "data_time", "import_active_power", "status", "note", "reading_date", F.col("ROW_HASH").isNotNull().alias("has_key")
    )


def stream_ingest(spark, folder):
    """The written files loaded by the file stream: one row per meter and minute."""
    files = arriving_files(spark, write_layouts(spark, folder), LAYOUT_FILES, recursive=True)
    target = scratch_path(spark, "streamed")
    start_loading(files, target, scratch_path(spark, "stream-checkpoint"), run_id=RUN.run_id).awaitTermination()
    return FactTable(spark, target).read().select("METER_ID", "DATA_TIME", "IMPORT_ACTIVE_POWER", "QUARTER")


def _as_text(rows):
    return rows.select(
        F.col("meter_id").alias("METER_ID"),
        F.date_format("data_time", "yyyy-MM-dd HH:mm:ss").alias("DATA_TIME"),
        F.col("import_active_power").alias("IMPORT_ACTIVE_POWER"),
    )


def _load(spark, places, run, rows):
    raw = scratch_path(spark, "raw")
    _as_text(rows).write.option("header", True).csv(raw)
    files_to_clean(spark, raw, places, run)
    clean_to_readings(spark, places, run)


def whole_run(spark, folder, model="violators"):
    """CSV files to clean Parquet to fact table to models; the violators at the end."""
    places = Places(scratch_path(spark, "run"))
    _load(spark, places, RUN, raw_readings(spark, folder))
    return readings_to_models(spark, places, RUN, schedule_rows(spark, folder), site_rows(spark, folder), SPEC)[model]


def whole_run_twice(spark, folder):
    """Two loads by date with a model run after each: consumption as the second, incremental run leaves it."""
    places, rows = Places(scratch_path(spark, "run")), raw_readings(spark, folder)
    inputs = schedule_rows(spark, folder), site_rows(spark, folder)
    _load(spark, places, RUN, _before(rows, LAST_DAY))
    readings_to_models(spark, places, RUN, *inputs, SPEC)
    second = Run("run_2", datetime(2024, 2, 2))
    _load(spark, places, second, _from(rows, LAST_DAY))
    return readings_to_models(spark, places, second, *inputs, SPEC)["consumption_analysis"]


def run_checks(spark, folder):
    """The checks of the second of two runs, which looks at the days of the second load only."""
    places, rows = Places(scratch_path(spark, "run")), raw_readings(spark, folder)
    inputs = schedule_rows(spark, folder), site_rows(spark, folder)
    second = Run("run_2", datetime(2024, 2, 2))
    for run, part in ((RUN, _before(rows, MIDDLE)), (second, _from(rows, MIDDLE))):
        _load(spark, places, run, part)
        found = readings_to_models(spark, places, run, *inputs, SPEC)["table_checks"]
    return found


def models_in_sql(spark, folder):
    """The models of a run under their names in SQL: energy and daily readings by region."""
    places, prefix = Places(scratch_path(spark, "run")), f"m{uuid.uuid4().hex}_"
    _load(spark, places, RUN, raw_readings(spark, folder))
    name_models(readings_to_models(spark, places, RUN, schedule_rows(spark, folder), site_rows(spark, folder), SPEC), prefix)
    return spark.sql(
        f"""
        select c.region, count(*) as meters, sum(d.days) as days, sum(d.readings) as readings, max(d.peak) as peak
        from {prefix}consumption_analysis c join (
          select meter_id, count(*) as days, sum(readings_count) as readings, max(max_daily_power_watts) as peak from {prefix}daily_usage group by meter_id
        ) d on d.meter_id = c.meter_id group by c.region"""
    )


QUERIES = {
    # staging: W1 P6 P7 P8 A7 A8 J11 F1-F12 F14-F17
    "stage_readings": staged,
    "dedup_latest": dedup_latest,
    "outlier_mask": outlier_mask,
    "exclude_dates": exclude_dates_query,
    "exclusion_stats": exclusion_stats_query,
    "staging_stats": staging_stats_query,
    "stage_sites": sites,
    "stage_schedule": schedule,
    "parse_timestamps": parse_timestamps,
    "row_key": row_key,
    # locations and periods: J1 J2 J3 W2 A13 F13 F18 P9 P10
    "nearest_location": nearest_query,
    "nearest_location_cells": nearest_by_cells,
    "attach_periods": periods,
    "attach_periods_salted": attach_periods_salted,
    "period_flags": period_flags,
    "schedule_repeats": schedule_repeats_query,
    # marts: A1-A6 A9-A12 A16 A17 J4-J6 P11-P16 P19-P25 W3 T1 T2
    "consumption": usage,
    "consumption_excluding": consumption_excluding,
    "meter_quality": quality,
    "flag_over": flag_over_query,
    "violators": violators_query,
    "regional_consumption": regional,
    "regional_violators": regional_violators_query,
    "regional_report": regional_report_query,
    "daily_usage": lambda s, d: daily_usage(staged(s, d)),
    "region_summary": lambda s, d: reports.region_summary(usage(s, d)),
    "top_violators": lambda s, d: reports.top_violators(violators_query(s, d)),
    "top_complete": lambda s, d: reports.top_complete(usage(s, d)),
    # incremental: K1-K5 J7 J8 J10 A15 ST3
    "insert_if_absent": insert_if_absent_query,
    "insert_if_absent_hash": insert_if_absent_hash,
    "load_counts": load_counts,
    "mixed_batches": mixed_batches,
    "upsert_by_key": upsert_by_key,
    "changed_meters": changed_meters_query,
    "readings_of_changed_meters": readings_of_changed,
    "new_pairs": new_pairs_query,
    "incremental_consumption": incremental_consumption,
    # statistics and checks: A14 A18 A19 J9 T3 F24 Q1-Q4 ST4
    "latest_run_stats": lambda s, d: stats.latest_run(daily_runs(s, d)),
    "filter_effectiveness": lambda s, d: stats.filter_effectiveness(daily_runs(s, d)),
    "run_not_in": run_not_in,
    "run_not_in_null": run_not_in_null,
    "stats_json": stats_json,
    "stats_table": stats_table,
    "file_profile": file_profile,
    "unique_check": unique_check,
    "not_null_check": not_null_check,
    "table_checks": table_checks,
    "table_checks_broken": table_checks_broken,
    "run_checks": run_checks,
    # files and streams: S1-S8 P1-P5 J12 U1-U3 ST1 ST2
    "csv_harmonised": csv_harmonised,
    "header_mapping": header_mapping,
    "proposed_mapping": proposed_mapping,
    "reference_load": reference_load,
    "unhashed_run": unhashed_run,
    "stream_ingest": stream_ingest,
    "file_stats_run": file_stats_run,
    "broken_lines_run": broken_lines_run,
    "gated_run": gated_run,
    "whole_run": whole_run,
    "whole_run_twice": whole_run_twice,
    "models_in_sql": models_in_sql,
}
