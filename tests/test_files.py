from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from registry.queries import write_layouts
from wattline.plans.refresh import Places, Run, clean_to_readings, files_to_clean, readings_to_models
from wattline.sources.delimited import (
    UnmappableFiles,
    count_rows,
    list_files,
    map_headers,
    read_layouts,
    read_readings,
    repair_proposals,
    sniff_headers,
)
from wattline.sources.reference import load_reference, normal_header, read_schedule, read_sites
from wattline.sources.runlog import read_stats, take_over
from wattline.sources.tables import EmptyOutput
from wattline.spec import HEADER_ALIASES, READING_COLUMNS, ModelSpec, QualitySpec
from wattline.streaming.arrivals import arriving_files, load_files, start_loading


def put(folder, name, *lines, encoding="utf-8", end="\n"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(end.join(lines).encode(encoding))


def mapping(spark, folder, proposals=None):
    mapped = map_headers(sniff_headers(list_files(spark, str(folder))), proposals)
    return {r.source_filename: r for r in mapped.collect()}


def test_separators_and_headers(spark, tmp_path):
    put(tmp_path, "comma.csv", "a,b,c", "1,2,3")
    put(tmp_path, "semi.csv", 'x;"y, z";w;', "1;2;3;")
    put(tmp_path, "tab.csv", "a\tb")
    put(tmp_path, "pipe.csv", " a | b|c ", end="\r\n")
    put(tmp_path, "tie.csv", "a;b,c")
    put(tmp_path, "none.csv", "abc", "1,2")
    put(tmp_path, "bom.csv", "a,b", encoding="utf-8-sig")
    put(tmp_path, "blank.csv", "", "1")
    put(tmp_path, "empty.csv", "")  # no bytes: not listed
    put(tmp_path, "other.txt", "a,b")
    put(tmp_path, "long.csv", ",".join(f"column_{i}" for i in range(9000)), "1")
    got = {r.source_filename: (r.separator, r.headers) for r in sniff_headers(list_files(spark, str(tmp_path))).collect()}
    assert set(got) == {f"{n}.csv" for n in ("comma", "semi", "tab", "pipe", "tie", "none", "bom", "blank", "long")}
    assert got["comma.csv"] == (",", ["a", "b", "c"])
    assert got["semi.csv"] == (";", ["x", "y, z", "w", ""])
    assert got["tab.csv"] == ("\t", ["a", "b"])
    assert got["pipe.csv"] == ("|", ["a", "b", "c"])
    assert got["tie.csv"][0] == "," and got["none.csv"] == (",", ["abc"])
    assert got["bom.csv"] == (",", ["a", "b"]) and got["blank.csv"] == (",", [""])
    assert len(got["long.csv"][1]) == 9000


def test_mapping_kinds(spark, tmp_path):
    put(tmp_path, "exact.csv", ",".join(c.lower() for c in READING_COLUMNS))
    put(tmp_path, "moved.csv", ",".join(reversed(READING_COLUMNS)))
    put(tmp_path, "alias.csv", "kw_imp,Mtr_Id,dt,TIME")
    put(tmp_path, "missing.csv", "METER_ID,DATA_TIME,VOLTS")
    got = mapping(spark, tmp_path)
    assert got["exact.csv"].kind == "full" and got["exact.csv"].mapping["DATA_TIME"] == 3
    assert got["moved.csv"].kind == "required" and got["moved.csv"].mapping == {"METER_ID": 14, "DATA_TIME": 11, "IMPORT_ACTIVE_POWER": 10}
    # TIME comes before DT in the list of spellings
    assert got["alias.csv"].mapping == {"METER_ID": 1, "DATA_TIME": 3, "IMPORT_ACTIVE_POWER": 0}
    assert got["missing.csv"].kind == "reject" and got["missing.csv"].mapping is None
    assert got["missing.csv"].problem == "no column for IMPORT_ACTIVE_POWER" and got["alias.csv"].problem is None


@pytest.mark.parametrize("target", list(HEADER_ALIASES))
def test_every_alias(spark, tmp_path, target):
    others = [c for c in HEADER_ALIASES if c != target]
    for alias in HEADER_ALIASES[target]:
        put(tmp_path, f"{alias}.csv", ",".join([*others, alias.lower()]))
    got = mapping(spark, tmp_path)
    assert len(got) == len(HEADER_ALIASES[target])
    assert all(r.kind == "required" and r.mapping[target] == 2 for r in got.values())


def test_proposals(spark, tmp_path):
    put(tmp_path, "a.csv", "Serial,When,Load")
    put(tmp_path, "part.csv", "Serial,When,Load")
    put(tmp_path, "twice.csv", "Serial,When,Load")
    put(tmp_path, "whole.csv", ",".join(["serial", "ID", "METER_NO", "when", "load", *READING_COLUMNS[5:]]))
    sniffed = sniff_headers(list_files(spark, str(tmp_path)))
    paths = {r.source_filename: r.path for r in sniffed.collect()}
    pairs = [("SERIAL", "METER_ID"), ("When", "DATA_TIME"), ("load ", "IMPORT_ACTIVE_POWER"), ("Ghost", "STATUS")]
    rows = [(paths[f], i, t) for f in ("a.csv", "whole.csv") for i, t in pairs]
    rows += [(paths["part.csv"], "When", "DATA_TIME")]
    rows += [(paths["twice.csv"], "When", "DATA_TIME"), (paths["twice.csv"], "Load", "DATA_TIME")]
    proposals = spark.createDataFrame(rows, "path string, incoming string, target string")
    fixed = {(r.path, r.target): r.name for r in repair_proposals(sniffed, proposals).collect()}
    assert fixed[(paths["a.csv"], "METER_ID")] == "Serial" and (paths["a.csv"], "STATUS") not in fixed
    got = mapping(spark, tmp_path, proposals)
    assert got["a.csv"].kind == "required" and got["a.csv"].mapping == {"METER_ID": 0, "DATA_TIME": 1, "IMPORT_ACTIVE_POWER": 2}
    assert got["whole.csv"].kind == "required" and got["whole.csv"].problem is None
    assert got["part.csv"].kind == "reject" and "METER_ID" in got["part.csv"].problem
    assert got["twice.csv"].kind == "reject" and got["twice.csv"].problem == "names repeat after mapping"


def test_read_readings(spark, tmp_path):
    put(tmp_path, "a.csv", "METER_ID,DATA_TIME,IMPORT_ACTIVE_POWER", "007,2025-08-02 00:30:10.46,  1.5", "8,bad,x", '"9","2025-08-02",')
    full = {c: "1" for c in READING_COLUMNS} | {"DATA_TIME": "2025-11-02 01:00:00", "EXPORT_ACTIVE_POWER": " 2.5 ", "STATUS": "ok"}
    put(tmp_path, "full.csv", ";".join(READING_COLUMNS).lower(), ";".join(full[c] for c in READING_COLUMNS))
    put(tmp_path, "headless.csv", "")
    put(tmp_path, "no_rows.csv", "METER,TIME,ACTIVE_POWER")
    clean, mapped = read_readings(spark, list_files(spark, str(tmp_path)))
    rows = {r.METER_ID: r for r in clean.collect()}
    assert set(rows) == {"7", "8", "9", "1"} and mapped.count() == 3
    assert (rows["7"].DATA_TIME, rows["7"].IMPORT_ACTIVE_POWER) == (datetime(2025, 8, 2, 0, 30), 1.5)
    assert (rows["7"].DATA_TIME_STR, rows["7"].QUARTER) == ("2025-08-02 00:30:00", "2025-Q3")
    assert (rows["8"].DATA_TIME, rows["8"].IMPORT_ACTIVE_POWER, rows["8"].QUARTER) == (None, None, None)
    assert (rows["9"].DATA_TIME, rows["9"].IMPORT_ACTIVE_POWER) == (datetime(2025, 8, 2), None)
    assert (rows["1"].EXPORT_ACTIVE_POWER, rows["1"].STATUS, rows["7"].STATUS) == (2.5, "ok", None)
    counts = {r.path.rsplit("/", 1)[1]: r.rows_input for r in count_rows(read_layouts(spark, mapped)).collect()}
    assert counts == {"a.csv": 3, "full.csv": 1}
    plain, _ = read_readings(spark, list_files(spark, str(tmp_path)), with_hash=False)
    assert "ROW_HASH" not in plain.columns


def test_rejects_and_resolver(spark, tmp_path):
    put(tmp_path, "good.csv", "METER,TIME,ACTIVE_POWER", "1,2025-01-01,5")
    put(tmp_path, "odd.csv", "Serial,When,Load", "2,2025-01-01,6")
    files = list_files(spark, str(tmp_path))
    with pytest.raises(UnmappableFiles, match="odd.csv"):
        read_readings(spark, files)
    kept, mapped = read_readings(spark, files, on_reject="skip")
    assert kept.count() == 1 and mapped.where("kind = 'reject'").count() == 1

    def resolver(unknown):
        pairs = F.create_map(*[F.lit(x) for x in ("serial", "METER_ID", "when", "DATA_TIME", "load", "IMPORT_ACTIVE_POWER")])
        names = unknown.select("path", F.explode("headers").alias("incoming"))
        return names.withColumn("target", pairs[F.lower("incoming")])

    resolved, _ = read_readings(spark, files, resolver=resolver)
    assert sorted((r.METER_ID, r.IMPORT_ACTIVE_POWER) for r in resolved.collect()) == [("1", 5.0), ("2", 6.0)]


def test_columns_are_read_from_their_true_place(spark, tmp_path):
    put(tmp_path, "index.csv", ",METER_ID,DATA_TIME,IMPORT_ACTIVE_POWER", "0,7,2025-01-01,5")
    put(tmp_path, "inner.csv", "METER_ID;;DATA_TIME;IMPORT_ACTIVE_POWER", "7;9;2025-01-01;5")
    put(tmp_path, "quoted.csv", '"note, free",METER_ID,DATA_TIME,IMPORT_ACTIVE_POWER', '"a, b",7,2025-01-01,5')
    put(tmp_path, "end.csv", "METER_ID,DATA_TIME,IMPORT_ACTIVE_POWER,", "7,2025-01-01,5,")
    put(tmp_path, "full.csv", ",".join(READING_COLUMNS) + ",", ",".join({"METER_ID": "7", "DATA_TIME": "2025-01-01", "IMPORT_ACTIVE_POWER": "5"}.get(c, "1") for c in READING_COLUMNS) + ",")
    clean, mapped = read_readings(spark, list_files(spark, str(tmp_path)))
    rows = clean.collect()
    assert len(rows) == 5 and all((r.METER_ID, r.DATA_TIME, r.IMPORT_ACTIVE_POWER) == ("7", datetime(2025, 1, 1), 5.0) for r in rows)
    assert {r.source_filename: r.kind for r in mapped.collect()}["full.csv"] == "full"


ODD_NAMES = ["a b.csv", "a#b.csv", "a%20b.csv", "a[1].csv", "a{1}.csv", "a+b.csv", "é.csv"]


def test_odd_file_names(spark, tmp_path):
    for i, name in enumerate(ODD_NAMES):
        put(tmp_path / "raw", name, "METER,TIME,ACTIVE_POWER", *[f"{i},2025-01-0{d + 1},5" for d in range(i + 1)])
    places = Places(str(tmp_path / "root"))
    assert files_to_clean(spark, str(tmp_path / "raw"), places, RUN1) == sum(range(1, len(ODD_NAMES) + 1))
    recorded = {r.source_filename: (r.status, r.rows_input, r.rows_output) for r in take_over(spark, places.handed_over(RUN1)).collect()}
    assert recorded == {name: ("success", i + 1, i + 1) for i, name in enumerate(ODD_NAMES)}


def test_equal_names_in_different_folders(spark, tmp_path):
    put(tmp_path / "raw" / "x", "f.csv", "METER,TIME,ACTIVE_POWER", "1,2025-01-01,5")
    put(tmp_path / "raw" / "y", "f.csv", "METER;TIME;ACTIVE_POWER", "2;2025-01-01;5", "2;2025-01-02;5")
    places = Places(str(tmp_path / "root"))
    files_to_clean(spark, str(tmp_path / "raw"), places, RUN1, recursive=True)
    assert sorted((r.source_filename, r.rows_input) for r in take_over(spark, places.handed_over(RUN1)).collect()) == [("f.csv", 1), ("f.csv", 2)]


def test_files_without_a_line_end(spark, tmp_path):
    (tmp_path / "binary.csv").write_bytes(b"x" * 600_000)
    put(tmp_path, "cr.csv", "METER,TIME,ACTIVE_POWER", "1,2025-01-01,5", end="\r")
    files = list_files(spark, str(tmp_path))
    with pytest.raises(UnmappableFiles, match="binary.csv: no line end"):
        read_readings(spark, files)
    clean, mapped = read_readings(spark, files, on_reject="skip")
    assert [(r.METER_ID, r.IMPORT_ACTIVE_POWER) for r in clean.collect()] == [("1", 5.0)]
    assert "no line end" in mapped.where("kind = 'reject'").first().problem


def test_repeated_steps_change_nothing(spark, tmp_path):
    raw, places = tmp_path / "raw", Places(str(tmp_path / "root"))
    put(raw, "one.csv", "METER_ID,DATA_TIME,IMPORT_ACTIVE_POWER", *rows_for(1), "9,bad,1", ",2024-01-01,2")
    put(raw, "odd.csv", "Serial,When", "1,2")
    for _ in range(2):
        assert files_to_clean(spark, str(raw), places, RUN1, on_reject="skip") == 6
    assert clean_to_readings(spark, places, RUN1).rows_inserted == 6
    assert clean_to_readings(spark, places, RUN1).rows_inserted == 0
    etl = read_stats(spark, places.stats).where("stage_name = 'etl'").collect()
    assert sorted((r.source_filename, r.status, r.rows_input, r.error_message) for r in etl) == [
        ("odd.csv", "failed", 0, "no column for METER_ID, DATA_TIME, IMPORT_ACTIVE_POWER"),
        ("one.csv", "success", 6, None),
    ]
    natural = Places(str(tmp_path / "natural"))
    files_to_clean(spark, str(raw), natural, RUN1, on_reject="skip")
    for inserted in (6, 0, 0):  # nulls in the key are known after the first load
        assert clean_to_readings(spark, natural, RUN1, ["METER_ID", "DATA_TIME"]).rows_inserted == inserted


def test_failed_rebuild_loses_nothing(spark, tmp_path, monkeypatch):
    from wattline.operators.loading import insert_if_absent
    from wattline.plans import refresh
    from wattline.spec import OutlierSpec

    places = Places(str(tmp_path / "root"))
    schema = "ROW_HASH long, METER_ID string, DATA_TIME timestamp_ntz, IMPORT_ACTIVE_POWER double"
    rows = [(i, "a", datetime(2024, 1, 1 + i % 3, i % 24), float(i)) for i in range(50)]
    insert_if_absent(spark, spark.createDataFrame(rows, schema), places.readings)
    fact = spark.read.parquet(places.readings)
    staged = sorted(map(str, refresh.refresh_staged(spark, fact, places).collect()))

    def fails(df, path, *args, **kwargs):
        from wattline.sources.tables import delete_path

        delete_path(spark, path)
        raise OSError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(refresh, "write_by_day", fails)
        with pytest.raises(OSError):
            refresh.refresh_staged(spark, fact, places, full_refresh=True)
    assert sorted(map(str, refresh.refresh_staged(spark, fact, places).collect())) == staged

    # a day corrected with as many rows is staged again, and other bounds stage everything again
    corrected = [(i, m, t, p + 0.5) for i, m, t, p in rows if t.day == 2]
    day = spark.createDataFrame(corrected, schema).withColumn("reading_date", F.to_date("DATA_TIME"))
    day.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("reading_date").parquet(places.readings)
    spark.catalog.refreshByPath(places.readings)
    fact = spark.read.parquet(places.readings)
    got = refresh.refresh_staged(spark, fact, places)
    highest = {t: max(p for _, _, u, p in corrected if u == t) for _, _, t, _ in corrected}
    assert got.where("day(reading_date) = 2").agg(F.sum("active_power_watts")).first()[0] == sum(highest.values())
    narrow = refresh.refresh_staged(spark, fact, places, OutlierSpec(low=0, high=10))
    assert narrow.agg(F.max("active_power_watts")).first()[0] <= 10


def test_two_years_of_schedule_are_refused(spark, tmp_path, reference):
    from wattline.operators.checks import CheckFailed

    raw, places = tmp_path / "raw", Places(str(tmp_path / "root"))
    put(raw, "one.csv", "METER_ID,DATA_TIME,IMPORT_ACTIVE_POWER", *rows_for(1))
    files_to_clean(spark, str(raw), places, RUN1)
    clean_to_readings(spark, places, RUN1)
    times, sites = reference
    twice = times.unionByName(times.withColumn("Date", F.regexp_replace("Date", "2023", "2024")))
    with pytest.raises(CheckFailed, match="schedule days repeat"):
        readings_to_models(spark, places, RUN1, twice, sites, SPEC)


def test_files_of_one_layout_are_one_scan(spark, tmp_path):
    for i in range(5):
        put(tmp_path, f"f{i}.csv", "METER,TIME,ACTIVE_POWER", f"{i},2025-01-01,5")
    clean, _ = read_readings(spark, list_files(spark, str(tmp_path)))
    assert clean._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1


def test_reference(spark, tmp_path):
    assert normal_header(" Meter Number (new) ") == "METER_NUMBER_NEW"
    put(tmp_path, "sites.csv", "Meter Number,Multiplication Factor,X Coordinates,Y Coordinates,Region,Province,Department Name,Office Name", "007,#,46.5,24.5,Central,RIYADH,d,o")
    put(tmp_path, "times.csv", "Coordinate,Date,Fajr,Dhuhr,Asr,Maghrib,Isha", '"(24.5, 46.5)",04-01-2023,04:40,12:00,15:30,18:05,19:30')
    assert read_sites(spark, str(tmp_path / "sites.csv")).first()["Meter Number"] == "007"
    assert read_schedule(spark, str(tmp_path / "times.csv")).first()["Coordinate"] == "(24.5, 46.5)"
    loaded = load_reference(spark, str(tmp_path / "sites.csv"), str(tmp_path / "table"))
    again = load_reference(spark, str(tmp_path / "sites.csv"), str(tmp_path / "table"))
    assert "MULTIPLICATION_FACTOR" in loaded.columns and "_LOADED_AT" in loaded.columns and again.count() == 1


# ---- the whole run --------------------------------------------------------

RUN1, RUN2 = Run("run_1", datetime(2025, 1, 1)), Run("run_2", datetime(2025, 1, 2))


@pytest.fixture
def reference(spark, tmp_path):
    folder = tmp_path / "reference"
    put(folder, "sites.csv", "Meter Number,Multiplication Factor,X Coordinates,Y Coordinates,Region,Province,Department Name,Office Name", "007,60,46.5,24.5,Central,AR RIYADH,d,o", "8,#,46.5,24.5,Central,AR RIYADH,d,o")
    lines = [f'"(24.5, 46.5)",{d:02}-01-2023,04:40,12:00,15:30,18:05,19:30' for d in range(1, 32)]
    put(folder, "times.csv", "Coordinate,Date,Fajr,Dhuhr,Asr,Maghrib,Isha", *lines)
    return read_schedule(spark, str(folder / "times.csv")), read_sites(spark, str(folder / "sites.csv"))


SPEC = ModelSpec(quality=QualitySpec(per_day=2))


def rows_for(day, meters=("7", "8")):
    return [f"{m},2024-01-{day:02} {h:02}:30:00,{100 * int(m)}" for m in meters for h in (8, 22)]


def test_whole_run(spark, tmp_path, reference):
    raw, places = tmp_path / "raw", Places(str(tmp_path / "root"))
    raw.mkdir()
    assert files_to_clean(spark, str(raw), places, RUN1) == 0  # nothing there: a clean no-op
    put(raw, "one.csv", "METER_ID,DATA_TIME,IMPORT_ACTIVE_POWER", *rows_for(1), *rows_for(2), *rows_for(2))
    assert files_to_clean(spark, str(raw), places, RUN1) == 12
    assert clean_to_readings(spark, places, RUN1).rows_inserted == 12
    models = readings_to_models(spark, places, RUN1, *reference, SPEC)
    assert models["staged_readings"].count() == 8
    usage = {r.meter_id: r for r in models["consumption_analysis"].collect()}
    assert usage["7"].total_sum_consumption == 2800.0 and usage["7"].multiplication_factor == 60.0
    assert [r.meter_id for r in models["violators"].collect()] == ["7"]
    assert models["riyadh_quarter_report"].first().total_meters_before_quality_filter == 2

    first_days = [tmp_path / "root" / "models" / t / "reading_date=2024-01-01" for t in ("staged_readings", "meter_days")]
    before = [sorted(p.name for p in day.iterdir()) for day in first_days]

    # the next day brings readings of one meter, and repeats old ones
    put(raw, "two.csv", "METER;TIME;ACTIVE_POWER", *[r.replace(",", ";") for r in rows_for(3, "7")])
    assert files_to_clean(spark, str(raw), places, RUN2) == 14
    counts = clean_to_readings(spark, places, RUN2)
    assert (counts.rows_inserted, counts.rows_skipped) == (2, 12)
    models = readings_to_models(spark, places, RUN2, *reference, SPEC)
    assert [sorted(p.name for p in day.iterdir()) for day in first_days] == before  # only the new day is built
    assert models["daily_usage"].count() == 5
    assert models["staged_readings"].count() == 10
    usage = {r.meter_id: r for r in models["consumption_analysis"].collect()}
    assert usage["7"].total_sum_consumption == 4200.0 and usage["8"].total_sum_consumption == 3200.0
    over = models["violators"].collect()
    assert [(r.meter_id, r.morning_reading_count) for r in over] == [("7", 2)]  # a recorded pair stays as it was

    refreshed = readings_to_models(spark, places, RUN2, *reference, SPEC, full_refresh=True)
    assert refreshed["violators"].first().morning_reading_count == 3
    again = {r.meter_id: tuple(r) for r in refreshed["consumption_analysis"].collect()}
    assert again == {k: tuple(v) for k, v in usage.items()}  # in date order, incremental equals full

    recorded = read_stats(spark, places.stats)
    by_stage = {(r.run_id, r.stage_name): r for r in recorded.where("source_filename = 'all_files'").collect()}
    assert set(by_stage) == {(r, s) for r in ("run_1", "run_2") for s in ("upload", "staging", "ramadan_filter")}
    assert recorded.groupBy("run_id", "stage_name", "source_filename").count().where("count > 1").isEmpty()
    assert (by_stage["run_2", "upload"].rows_duplicates_skipped, by_stage["run_1", "staging"].rows_filtered) == (12, 4)
    files = {r.source_filename: r.rows_output for r in recorded.where("run_id = 'run_2' and stage_name = 'etl'").collect()}
    assert files == {"one.csv": 12, "two.csv": 2}


def test_staged_days_follow_the_facts(spark, tmp_path):
    """Late copies, new days and rows without a key: day by day equals staging everything."""
    from wattline.operators.loading import insert_if_absent
    from wattline.operators.staging import stage_readings
    from wattline.plans.refresh import refresh_staged

    places = Places(str(tmp_path / "root"))
    schema = "ROW_HASH long, METER_ID string, DATA_TIME timestamp_ntz, IMPORT_ACTIVE_POWER double"
    at = [datetime(2024, 1, d, 8) for d in (1, 2, 3)]
    loads = [
        [(1, "a", at[0], 5.0), (2, "a", at[1], 5.0), (42, None, at[0], 1.0)],
        [(3, "b", at[0], 6.0), (4, "a", at[0], 9.0)],  # late rows for the first day, one a higher copy
        [(5, "a", at[2], 7.0), (43, "c", None, 8.0)],
        [(2, "a", at[1], 5.0)],  # known: nothing changes
    ]
    for rows in loads:
        insert_if_absent(spark, spark.createDataFrame(rows, schema), places.readings)
        fact = spark.read.parquet(places.readings)
        got = sorted(map(str, refresh_staged(spark, fact, places).collect()))
        assert got == sorted(map(str, stage_readings(fact).collect()))
    assert len(got) == 5
    again = refresh_staged(spark, spark.read.parquet(places.readings), places, full_refresh=True)
    assert sorted(map(str, again.collect())) == got


def test_run_without_rows_fails(spark, tmp_path):
    raw, places = tmp_path / "raw", Places(str(tmp_path / "root"))
    put(raw, "one.csv", "METER_ID,DATA_TIME,IMPORT_ACTIVE_POWER")
    with pytest.raises(EmptyOutput):
        files_to_clean(spark, str(raw), places, RUN1)


def test_failed_load_is_recorded(spark, tmp_path):
    places = Places(str(tmp_path / "root"))
    with pytest.raises(Exception):
        clean_to_readings(spark, places, RUN1)
    row = read_stats(spark, places.stats).first()
    assert (row.status, row.stage_name) == ("failed", "upload") and row.error_message


# ---- streams --------------------------------------------------------------


def test_stream_loads_each_file_once(spark, tmp_path):
    raw, target, checkpoint, log = (str(tmp_path / n) for n in ("raw", "target", "checkpoint", "stats"))
    put(tmp_path / "raw", "one.csv", "METER_ID,DATA_TIME,IMPORT_ACTIVE_POWER", *rows_for(1), *rows_for(1))

    def run():
        query = start_loading(arriving_files(spark, raw, max_files_per_batch=1), target, checkpoint, run_id="s1", stats_path=log)
        query.awaitTermination()
        return spark.read.parquet(target)

    assert run().count() == 4
    put(tmp_path / "raw", "two.csv", "METER|TIME|ACTIVE_POWER", *[r.replace(",", "|") for r in rows_for(1) + rows_for(2)])
    put(tmp_path / "raw", "three.csv", "METER_ID,DATA_TIME,IMPORT_ACTIVE_POWER")
    assert run().count() == 8
    assert run().count() == 8
    logged = sorted((r.source_filename, r.rows_output, r.rows_filtered) for r in read_stats(spark, log).collect())
    assert logged[0] == ("batch_0", 4, 4) and logged[1][1:] == (4, 4) and len(logged) == 2


def test_repeated_batch_adds_nothing(spark, tmp_path):
    put(tmp_path / "raw", "one.csv", "METER_ID,DATA_TIME,IMPORT_ACTIVE_POWER", *rows_for(1), "9,bad,1")
    files, target = list_files(spark, str(tmp_path / "raw")), str(tmp_path / "target")
    assert load_files(files, target).rows_inserted == 5
    assert load_files(files, target).rows_inserted == 0


def test_stream_equals_batch(spark, tmp_path):
    """One file per batch, against the batch steps over all files; undated and id-less rows included."""
    from wattline.operators.staging import stage_readings

    places, calls = Places(str(tmp_path / "root")), []
    for day in (1, 2, 3):
        odd = ["9,bad,1", "9,bad,2", ",2024-01-05,3"] if day == 1 else []
        put(tmp_path / "raw", f"{day}.csv", "METER_ID,DATA_TIME,IMPORT_ACTIVE_POWER", *rows_for(day), *odd)
    files = arriving_files(spark, str(tmp_path / "raw"), max_files_per_batch=1)
    start_loading(files, str(tmp_path / "s"), str(tmp_path / "c"), run_id="s", recompute=calls.append).awaitTermination()
    files_to_clean(spark, str(tmp_path / "raw"), places, RUN1)
    clean_to_readings(spark, places, RUN1)
    columns = ["METER_ID", "DATA_TIME", "IMPORT_ACTIVE_POWER", "ROW_HASH"]
    one, two = (spark.read.parquet(p).select(columns) for p in (str(tmp_path / "s"), places.readings))
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty() and one.count() == 15 and len(calls) == 3
    assert stage_readings(one).exceptAll(stage_readings(two)).isEmpty()


def test_stream_keeps_one_copy_and_counts_the_others(spark, tmp_path):
    for day in (1, 2, 3):
        put(tmp_path / "raw", f"{day}.csv", "METER_ID,DATA_TIME,IMPORT_ACTIVE_POWER", *rows_for(day), *rows_for(1))
    files = arriving_files(spark, str(tmp_path / "raw"), max_files_per_batch=1)
    start_loading(files, str(tmp_path / "s"), str(tmp_path / "c"), run_id="s").awaitTermination()
    counts = load_files(list_files(spark, str(tmp_path / "raw")), str(tmp_path / "b"))
    assert (counts.rows_input, counts.rows_inserted) == (24, 12)
    columns = ["METER_ID", "DATA_TIME", "IMPORT_ACTIVE_POWER", "ROW_HASH"]
    one, two = (spark.read.parquet(str(tmp_path / n)).select(columns) for n in "sb")
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty() and one.count() == 12
    assert one.agg(F.max(F.to_date("DATA_TIME"))).first()[0] == date(2024, 1, 3)


def test_broken_lines_are_counted_and_kept_apart(spark, tmp_path):
    raw, places = tmp_path / "raw", Places(str(tmp_path / "root"))
    put(
        raw, "one.csv", "note,METER_ID,DATA_TIME,IMPORT_ACTIVE_POWER", '"a,b",1,2024-01-01 00:00:00,5', "a,b,2,2024-01-01 00:00:00,6",
        "x,3,2024-01-01 00:30:00", "c,4,2024-01-01 01:00:00,7,,", "y,5,2024-01-01 01:30:00,8",
    )
    put(raw, "two.csv", "METER_ID,DATA_TIME,IMPORT_ACTIVE_POWER", "1,2,3,4", "5,6,7,8")
    assert files_to_clean(spark, str(raw), places, RUN1) == 3
    told = {r.source_filename: r for r in take_over(spark, places.handed_over(RUN1)).collect()}
    one, two = told["one.csv"], told["two.csv"]
    assert (one.rows_input, one.rows_output, one.rows_filtered, one.rows_with_null_power, one.status) == (5, 3, 2, 1, "success")
    assert (two.rows_input, two.rows_output, two.status) == (2, None, "failed")
    assert clean_to_readings(spark, places, RUN1).rows_inserted == 3


def test_a_gate_keeps_the_last_good_output(spark, tmp_path):
    from wattline.operators.checks import CheckFailed
    from wattline.sources.tables import read_quarters

    raw, places = tmp_path / "raw", Places(str(tmp_path / "root"))
    header = "METER_ID,DATA_TIME,IMPORT_ACTIVE_POWER"
    put(raw, "one.csv", header, *rows_for(1))
    written_rows = files_to_clean(spark, str(raw), places, RUN1)
    good = sorted(map(str, read_quarters(spark, places.clean(RUN1)).collect()))
    assert len(good) == written_rows
    put(raw, "one.csv", header)
    with pytest.raises(EmptyOutput):
        files_to_clean(spark, str(raw), places, RUN1)
    put(raw, "one.csv", header, "1,2,3,4")
    with pytest.raises(EmptyOutput):
        files_to_clean(spark, str(raw), places, RUN1)
    put(raw, "one.csv", header, *rows_for(1), "1,2,3,4")
    with pytest.raises(CheckFailed):
        files_to_clean(spark, str(raw), places, RUN1, max_rejected=0.0)
    assert sorted(map(str, read_quarters(spark, places.clean(RUN1)).collect())) == good
    files_to_clean(spark, str(raw), places, RUN1)
    assert read_quarters(spark, places.clean(RUN1), rejects=True).where("rejected").count() == 1


def test_publishing_that_breaks_off_loses_nothing(spark, tmp_path, monkeypatch):
    from wattline.sources import tables

    def folder(name, text):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f").write_text(text)
        return str(tmp_path / name)

    place = folder("place", "old")
    # what stood there was moved aside, the new one not moved in
    (tmp_path / "place").rename(tmp_path / "_before.place")
    tables.recover(spark, place)
    assert (tmp_path / "place" / "f").read_text() == "old"
    # the new one was moved in, the old one not deleted
    folder("_before.place", "older")
    tables.recover(spark, place)
    assert (tmp_path / "place" / "f").read_text() == "old" and not (tmp_path / "_before.place").exists()
    tables.publish(spark, folder("built", "new"), place)
    assert (tmp_path / "place" / "f").read_text() == "new" and not (tmp_path / "built").exists()


def test_every_layout_is_written_by_many_tasks(spark, tmp_path):
    rows = [(i, datetime(2024, 1, 1 + i % 3, i % 24), i % 7, "view", float(i % 300), "") for i in range(50)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.write.parquet(str(tmp_path / "events.parquet"))
    root = write_layouts(spark, str(tmp_path))
    for number, header in ((4, ',METER_ID,"note, free",DATA_TIME,IMPORT_ACTIVE_POWER'), (5, "METER_ID;;DATA_TIME;IMPORT_ACTIVE_POWER;")):
        texts = [f.read_text().splitlines() for f in Path(root, f"layout={number}").glob("part-*")]
        assert len(texts) > 1 and {t[0] for t in texts if t} == {header}
        assert sum(len(t) - 1 for t in texts if t) == 100
    assert any('5,000,"a,b",2024-01-01 00:00:00.4600000, 0.0' in t for t in Path(root, "layout=4").glob("part-*") for t in t.read_text().splitlines())
