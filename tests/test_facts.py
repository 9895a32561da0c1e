"""The fact table's recorded schema, runs that read changed days only, and key lookups that shuffle candidates only."""

import os
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.operators.joins import possible_matches
from wattline.operators.loading import insert_if_absent
from wattline.operators.staging import stage_readings
from wattline.plans.refresh import Places, refresh_staged
from wattline.sources.facts import FactTable, SchemaConflict, day_files, united, wider
from wattline.spec import READING_COLUMNS

AT = [datetime(2024, 1, d, 8) for d in range(1, 10)]


def fields(text):
    return T._parse_datatype_string(text)


def test_schemas_unite(spark):
    known = fields("METER_ID string, P int, Q float")
    assert united(known, fields("meter_id string, p long, q double, note void")) == fields("METER_ID string, P long, Q double, note string")
    assert united(known, fields("P byte")) == known
    assert wider("P", T.IntegerType(), T.DoubleType()) == T.DoubleType()
    for a, b in (("P string", "P int"), ("P long", "P double"), ("P date", "P timestamp")):
        with pytest.raises(SchemaConflict):
            united(fields(a), fields(b))


def test_batches_of_different_columns_are_read_back_whole(spark, tmp_path):
    """A full layout, a short one and one without key: whichever file a reader would look at first, nothing is lost."""
    full = spark.createDataFrame(
        [(1, "a", AT[0], 5.0, "on"), (2, "a", AT[1], 6.0, "off")], "ROW_HASH long, METER_ID string, DATA_TIME timestamp_ntz, IMPORT_ACTIVE_POWER double, STATUS string"
    )
    for name in READING_COLUMNS:
        if name not in full.columns:
            full = full.withColumn(name, F.lit("x"))
    short = spark.createDataFrame([(3, "b", AT[0], 7.0)], "ROW_HASH long, METER_ID string, DATA_TIME timestamp_ntz, IMPORT_ACTIVE_POWER double")
    keyless = short.drop("ROW_HASH").withColumn("METER_ID", F.lit("c"))
    for order in ((full, short, keyless), (keyless, short, full), (short, keyless, full)):
        path = str(tmp_path / f"t{len(list(tmp_path.iterdir()))}")
        for batch in (*order, *order[:2]):
            insert_if_absent(spark, batch, path)
        rows = FactTable(spark, path).read()
        assert set(rows.columns) == {*full.columns, "reading_date"}
        got = [(r.METER_ID, r.DATA_TIME, r.ROW_HASH, r.STATUS, r.ID) for r in rows.collect()]
        want = [("a", AT[0], 1, "on", "x"), ("a", AT[1], 2, "off", "x"), ("b", AT[0], 3, None, None)]
        # without a key nothing is known, so that batch comes twice where it is loaded twice
        want += [("c", AT[0], None, None, None)] * (2 if keyless in order[:2] else 1)
        assert sorted(map(str, got)) == sorted(map(str, want))


def test_types_widen_and_conflicts_leave_the_table_alone(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "ROW_HASH {}, METER_ID string, DATA_TIME timestamp_ntz, N {}"
    insert_if_absent(spark, spark.createDataFrame([(1, "a", AT[0], 5)], schema.format("int", "int")), path)
    insert_if_absent(spark, spark.createDataFrame([(1, "a", AT[0], 5.5), (2**40, "b", AT[1], 6.5)], schema.format("long", "double")), path)
    assert sorted((r.ROW_HASH, r.N) for r in FactTable(spark, path).read().collect()) == [(1, 5.0), (2**40, 6.5)]
    with pytest.raises(SchemaConflict):
        insert_if_absent(spark, spark.createDataFrame([(3, "a", AT[0], "x")], schema.format("long", "string")), path)
    assert FactTable(spark, path).read().count() == 2


def test_table_from_before_the_record(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, date(2024, 1, 1))], "ROW_HASH long, reading_date date")
    rows.write.partitionBy("reading_date").parquet(path)
    rows.drop("ROW_HASH").withColumn("METER_ID", F.lit("m")).write.mode("append").partitionBy("reading_date").parquet(path)
    found = FactTable(spark, path).read()
    assert sorted(map(str, found.select("ROW_HASH", "METER_ID").collect())) == ["Row(ROW_HASH=1, METER_ID=None)", "Row(ROW_HASH=None, METER_ID='m')"]
    with pytest.raises(FileNotFoundError):
        FactTable(spark, str(tmp_path / "none")).read()


def test_days_of_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, "a", AT[0], 1.0), (2, "a", AT[1], 1.0), (3, "a", None, 1.0)]
    insert_if_absent(spark, spark.createDataFrame(rows, "ROW_HASH long, METER_ID string, DATA_TIME timestamp_ntz, P double"), path)
    files = day_files(spark, path, "reading_date").collect()
    assert sorted(map(str, {r.reading_date for r in files})) == ["2024-01-01", "2024-01-02", "None"] and all(r.length > 0 for r in files)


def test_a_second_run_reads_changed_days_only(spark, tmp_path):
    """The files of days that did not change are made unreadable: the run must not look into them."""
    places = Places(str(tmp_path / "root"))
    schema = "ROW_HASH long, METER_ID string, DATA_TIME timestamp_ntz, IMPORT_ACTIVE_POWER double"
    first = [(i, f"m{i % 3}", AT[i % 5], float(i)) for i in range(50)] + [(900, None, AT[0], 3.0), (901, "u", None, 9.0)]
    insert_if_absent(spark, spark.createDataFrame(first, schema), places.readings)
    refresh_staged(spark, FactTable(spark, places.readings).read(), places)
    second = [(1000, "m1", AT[4], 77.0), (1001, "m1", AT[7], 8.0), (1002, None, AT[4], 50.0)]
    insert_if_absent(spark, spark.createDataFrame(second, schema), places.readings)
    want = sorted(map(str, stage_readings(spark.createDataFrame(first + second, schema)).collect()))
    for file in Path(places.readings).rglob("*.parquet"):
        if not any(f"reading_date={d:%Y-%m-%d}" in str(file) for d in (AT[4], AT[7])):
            times = file.stat()
            file.write_bytes(bytes(times.st_size))
            os.utime(file, ns=(times.st_atime_ns, times.st_mtime_ns))
    got = refresh_staged(spark, FactTable(spark, places.readings).read(), places)
    assert sorted(map(str, got.collect())) == want
    days = spark.read.parquet(places.model("fact_days"))
    assert days.agg(F.sum("fact_rows")).first()[0] == len(first + second)


def test_possible_matches(spark):
    facts = spark.range(100_000).select(F.when(F.col("id") % 1000 != 0, F.col("id")).alias("k"), (F.col("id") % 7).alias("d"), F.lit("x").alias("_bits2"))
    keys = spark.range(200_000, 210_000).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("d"))
    some = facts.where("k % 5000 = 1 or (k is null and d = 1)").select("k", "d")
    near = possible_matches(facts, keys.unionByName(some), ["k", "d"])
    assert near.columns == facts.columns
    assert near.join(some.distinct(), (near.k.eqNullSafe(some.k)) & (near.d == some.d), "left_semi").count() == facts.join(
        some.distinct(), (facts.k.eqNullSafe(some.k)) & (facts.d == some.d), "left_semi"
    ).count()
    # of 100,000 unlike keys against 10,000 in 16 million places some 60 pass by chance
    assert possible_matches(facts, keys, ["k", "d"]).count() < 300
    plan = possible_matches(facts, keys, ["k", "d"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
