from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wattline.operators import checks, stats
from wattline.operators.loading import (
    changed_meters,
    high_water_mark,
    insert_if_absent,
    new_pairs,
    readings_of_changed_meters,
    upsert,
    upserted,
)
from wattline.sources import runlog, scratch
from wattline.sources.tables import EmptyOutput, VersionedTable

ROWS = "ROW_HASH long, METER_ID string, DATA_TIME timestamp_ntz, IMPORT_ACTIVE_POWER double"
T1, T2 = datetime(2024, 1, 1, 1), datetime(2024, 1, 2, 1)


def batch(spark, *rows):
    return spark.createDataFrame(rows, ROWS)


def content(spark, path):
    return sorted((r.ROW_HASH, r.IMPORT_ACTIVE_POWER) for r in spark.read.parquet(path).collect())


def test_insert_if_absent(spark, tmp_path):
    path = str(tmp_path / "target")
    first = batch(spark, (1, "a", T1, 1.0), (1, "a", T1, 2.0), (2, "a", T2, 3.0))
    counts = insert_if_absent(spark, first, path)
    assert (counts.rows_input, counts.rows_inserted, counts.rows_skipped) == (3, 3, 0)  # copies in a first load stay
    again = insert_if_absent(spark, first, path)
    assert (again.rows_inserted, again.rows_skipped) == (0, 3)
    second = batch(spark, (1, "a", T1, 9.0), (3, "b", T2, 4.0), (3, "b", T2, 5.0), (42, None, None, 6.0))
    counts = insert_if_absent(spark, second, path)
    assert (counts.rows_inserted, counts.rows_skipped) == (3, 1)  # existing rows never change; batch copies stay
    assert content(spark, path) == [(1, 1.0), (1, 2.0), (2, 3.0), (3, 4.0), (3, 5.0), (42, 6.0)]
    undated = insert_if_absent(spark, batch(spark, (42, "z", None, 7.0)), path)
    assert undated.rows_inserted == 0


def test_nulls_in_a_natural_key_are_equal(spark, tmp_path):
    path, keys = str(tmp_path / "target"), ["METER_ID", "DATA_TIME"]
    rows = batch(spark, (1, "a", T1, 1.0), (2, None, T1, 2.0), (3, "a", None, 3.0))
    assert [insert_if_absent(spark, rows, path, keys).rows_inserted for _ in range(3)] == [3, 0, 0]


def test_equal_hashes_of_different_days_are_different(spark, tmp_path):
    path = str(tmp_path / "target")
    insert_if_absent(spark, batch(spark, (1, "a", T1, 1.0)), path)
    assert insert_if_absent(spark, batch(spark, (1, "b", T2, 1.0)), path).rows_inserted == 1


def test_insert_without_key_appends(spark, tmp_path):
    path = str(tmp_path / "target")
    rows = batch(spark, (1, "a", T1, 1.0)).drop("ROW_HASH")
    insert_if_absent(spark, rows, path)
    insert_if_absent(spark, rows, path)
    assert spark.read.parquet(path).count() == 2


def test_empty_batch_is_an_error(spark, tmp_path):
    with pytest.raises(EmptyOutput):
        insert_if_absent(spark, spark.createDataFrame([], ROWS), str(tmp_path / "t"))


def test_insert_reads_only_the_days_of_the_batch(spark, tmp_path):
    from wattline.operators.loading import _same_days

    path = str(tmp_path / "target")
    insert_if_absent(spark, batch(spark, (1, "a", T1, 1.0), (2, "a", T2, 3.0)), path)
    rows = batch(spark, (5, "a", T2, 1.0)).withColumn("reading_date", F.to_date("DATA_TIME"))
    kept = _same_days(spark.read.parquet(path), rows)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reading_date" in plan and kept.count() == 1


def test_many_days_fall_back_to_their_range(spark, tmp_path, monkeypatch):
    from wattline.operators import loading

    monkeypatch.setattr(loading, "MAX_DAY_LIST", 1)
    path = str(tmp_path / "target")
    rows = batch(spark, (1, "a", T1, 1.0), (2, "a", T2, 3.0), (42, None, None, 1.0))
    insert_if_absent(spark, rows, path)
    assert insert_if_absent(spark, rows, path).rows_inserted == 0


def test_new_columns_are_kept(spark, tmp_path):
    path = str(tmp_path / "target")
    insert_if_absent(spark, batch(spark, (1, "a", T1, 1.0)), path)
    insert_if_absent(spark, batch(spark, (2, "a", T1, 1.0)).withColumn("STATUS", F.lit("ok")), path)
    got = spark.read.option("mergeSchema", True).parquet(path).orderBy("ROW_HASH").collect()
    assert [r.STATUS for r in got] == [None, "ok"]


def test_upsert(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    upsert(table, spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int"), ["k"])
    upsert(table, spark.createDataFrame([("b", 5, "x"), ("c", 6, "y"), (None, 7, "z")], "k string, v int, w string"), ["k"])
    got = sorted(((r.k or "", r.v, r.w) for r in table.read().collect()), key=str)
    # old keys stay, null keys never match, new columns are null for old rows
    assert got == sorted([("a", 1, None), ("b", 5, "x"), ("c", 6, "y"), ("", 3, None), ("", 7, "z")], key=str)


def test_unfinished_version_is_not_read(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(3))
    unfinished = tmp_path / "t" / "version=2"
    spark.range(5).write.parquet(str(unfinished))
    (unfinished / "_SUCCESS").unlink()
    assert table.read().count() == 3
    table.replace(spark.range(7))
    assert table.read().count() == 7
    table.drop_old(keep=1)
    assert table.read().count() == 7


def test_upsert_twice_changes_nothing(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3)], "k string, v int")
    once = upserted(old, new, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, upserted(once, new, ["k"]).collect()))


def test_changed_meters(spark):
    readings = spark.createDataFrame(
        [("a", date(2024, 1, 1)), ("a", date(2024, 1, 5)), ("b", date(2024, 1, 3)), ("late", date(2024, 1, 2)), ("n", None)],
        "meter_id string, reading_date date",
    ).withColumn("reading_at", F.col("reading_date").cast("timestamp_ntz"))
    done = spark.createDataFrame([("a", date(2024, 1, 3)), ("b", date(2024, 1, 2))], "meter_id string, max_reading_date date")
    assert [r.meter_id for r in changed_meters(readings, done).collect()] == ["a"]
    for bound in (0, 10_000):
        assert readings_of_changed_meters(readings, done, max_broadcast_bytes=bound).count() == 2
    assert high_water_mark(done.where("false")).first()[0] == date(1900, 1, 1)
    assert changed_meters(readings, done.where("false")).count() == 3


def test_new_pairs(spark):
    used = spark.createDataFrame([("a", "2024-Q1"), ("a", "2024-Q2"), ("b", None)], "meter_id string, quarter string")
    done = spark.createDataFrame([("a", "2024-Q1"), ("b", None)], "meter_id string, quarter string")
    assert sorted(map(tuple, new_pairs(used, done).collect()), key=str) == [("a", "2024-Q2"), ("b", None)]


def run(spark, run_id, **more):
    return stats.stats_rows(spark, [{"run_id": run_id, "run_timestamp": T1, "source_filename": "f", "stage_name": "s", **more}])


def test_not_yet_run(spark):
    assert stats.not_yet_run(run(spark, "r1"), run(spark, "r2")).count() == 1
    assert stats.not_yet_run(run(spark, "r1"), run(spark, "r1")).count() == 0
    assert stats.not_yet_run(run(spark, "r1"), run(spark, "r1").where("false")).count() == 1
    with_null = run(spark, "r2").withColumn("run_id", F.lit(None).cast("string"))
    assert stats.not_yet_run(run(spark, "r1"), with_null).count() == 0


def test_stats_table(spark, tmp_path):
    path, handed = str(tmp_path / "stats"), str(tmp_path / "handed")
    assert runlog.read_stats(spark, path).isEmpty() and runlog.take_over(spark, handed).isEmpty()
    runlog.append_records(spark, [], path)
    runlog.append_records(
        spark,
        [{"run_id": "r1", "run_timestamp": T1, "source_filename": "f", "stage_name": "upload", "status": "failed", "error_message": "e" * 600}],
        path,
    )
    runlog.hand_over(run(spark, "r1", rows_input=5, min_reading_date=date(2024, 1, 1)), handed)
    runlog.append_stats(runlog.take_over(spark, handed), path)
    got = {r.stage_name: r for r in runlog.read_stats(spark, path).collect()}
    assert len(got["upload"].error_message) == 500
    assert (got["s"].rows_input, got["s"].min_reading_date, got["s"].run_timestamp) == (5, date(2024, 1, 1), T1)
    with pytest.raises(ValueError):
        stats.stats_rows(spark, [{"run": "x"}])


def test_run_id(monkeypatch):
    monkeypatch.setenv("PIPELINE_RUN_ID", "given")
    assert runlog.run_id() == "given"
    monkeypatch.delenv("PIPELINE_RUN_ID")
    assert runlog.run_id().startswith("local_2")


def test_exclusion_stats(spark):
    days = [date(2024, 1, d) for d in (1, 2, 3)] + [None]
    staged = spark.createDataFrame([("a", d) for d in days], "meter_id string, reading_date date")
    off = stats.exclusion_stats(staged, None, "r", T1).first()
    assert (off.rows_input, off.rows_output, off.rows_filtered, off.filter_reason) == (4, 4, 0, "no_ramadan_filter_active")
    on = stats.exclusion_stats(staged, (date(2024, 1, 2), date(2024, 1, 3)), "r", T1).first()
    assert (on.rows_input, on.rows_output, on.rows_filtered) == (4, 1, 2)  # the undated row is in neither
    assert on.filter_reason == "ramadan_dates_2024-01-02_to_2024-01-03"
    nothing = stats.exclusion_stats(staged, (date(2025, 1, 2), date(2025, 1, 3)), "r", T1).first()
    assert nothing.filter_reason == "no_ramadan_filter_active"


def test_file_stats(spark):
    clean = spark.createDataFrame(
        [("f1", "a", T1, 0.0), ("f1", None, T2, None), ("f1", "a", None, 1.0)],
        "source_filename string, METER_ID string, DATA_TIME timestamp_ntz, IMPORT_ACTIVE_POWER double",
    )
    inputs = spark.createDataFrame([("f1", 5, 100), ("f2", 3, 7)], "source_filename string, rows_input long, file_size_bytes long")
    got = {r.source_filename: r for r in stats.file_stats(clean, inputs, "r", T1).collect()}
    f1, f2 = got["f1"], got["f2"]
    assert (f1.rows_output, f1.rows_filtered, f1.filter_reason, f1.unique_meters) == (3, 2, "date_parse_failures", 2)
    assert (f1.rows_with_null_power, f1.rows_with_zero_power, f1.status) == (1, 1, "success")
    assert (f2.status, f2.rows_output, f2.file_size_bytes) == ("failed", None, 7)


def test_effectiveness_of_empty_input(spark):
    row = stats.filter_effectiveness(run(spark, "r", rows_input=0, rows_filtered=0)).first()
    assert row.filter_pct is None


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("b", None)], "k string, v int")
    assert [tuple(r) for r in checks.duplicate_keys(df, ["k", "v"]).collect()] == [("a", 1, 2)]
    assert [tuple(r) for r in checks.null_counts(df, ["k", "v"]).collect()] == [("v", 2)]
    with pytest.raises(checks.CheckFailed):
        checks.require_none(checks.duplicate_keys(df, ["k"]), "k repeats")
    checks.require_none(checks.null_counts(df, ["k"]), "k is null")


class FakeSession:
    """Just the settings ``scratch_root`` looks at."""

    def __init__(self, folder, master):
        self.conf = {scratch.SETTING: folder}
        self.sparkContext = self
        self.master, self.applicationId = master, "app"


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch.scratch_root(FakeSession("/shared/x/", "yarn")) == "/shared/x"
    with pytest.raises(ValueError):
        scratch.scratch_root(FakeSession(None, "yarn"))
    own = scratch.scratch_root(FakeSession(None, "local[2]"))
    assert own == scratch.scratch_root(FakeSession(None, "local[2]"))
    given = spark.conf.get(scratch.SETTING, None)
    assert given is None or scratch.scratch_root(spark) == given.rstrip("/")


def test_scratch_area_is_emptied(spark):
    from pathlib import Path

    with scratch.scratch_area(spark):
        frame = scratch.written(spark.range(3), "x")
        folder = Path(frame.inputFiles()[0].removeprefix("file://")).parent
        assert frame.count() == 3 and folder.exists()
    assert not folder.exists()
