"""Bucketed tables, packed days and the ledger of batches."""

import random
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wattline.operators.loading import LoadCounts, upsert, upserted
from wattline.operators.stats import stats_rows
from wattline.sources import buckets as buckets_module
from wattline.sources.buckets import BucketedTable
from wattline.sources.facts import compact_days, mend_days
from wattline.sources.runlog import append_stats, read_stats
from wattline.sources.tables import VersionedTable
from wattline.streaming.arrivals import BatchLedger, arriving_files, start_loading


def rows_of(frame):
    return sorted(str(sorted(r.asDict().items())) for r in frame.collect())


def test_upserts_equal_those_of_a_whole_table(spark, tmp_path):
    rng, want = random.Random(1), None
    table = BucketedTable(spark, str(tmp_path / "t"), ["a", "b"], buckets=7)
    for step in range(5):
        pairs = {(rng.choice(["x", "y", "z", None]) if step else "x", rng.randrange(8)) for _ in range(6)}
        new = spark.createDataFrame([(a, b, float(step)) for a, b in pairs], "a string, b long, v double")
        if step == 3:
            new = new.withColumn("extra", F.lit("e"))
        got = upsert(table, new, ["a", "b"])
        want = new if want is None else upserted(want, new, ["a", "b"])
        assert rows_of(got.select(*want.columns)) == rows_of(want)
    assert upsert(table, new.where("false"), ["a", "b"]).count() == got.count()
    with pytest.raises(ValueError):
        upsert(table, new, ["a"])


def test_untouched_buckets_are_neither_read_nor_written(spark, tmp_path):
    path = str(tmp_path / "t")
    table = BucketedTable(spark, path, ["k"], buckets=16)
    table.replace(spark.range(400).select(F.col("id").cast("string").alias("k"), F.lit(0).alias("v")))
    new = spark.createDataFrame([("7", 1), ("new", 1)], "k string, v int")
    touched = {r[0] for r in new.select(table._bucket(16)).collect()}
    before = {b: v for b, v in table._manifest()["current"].items()}
    spoiled = [f for f in Path(path).rglob("*.parquet") if int(f.parent.name.split("=")[1]) not in touched]
    kept = {f: f.read_bytes() for f in spoiled}
    for f in spoiled:
        f.write_bytes(b"unreadable")
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    table.upsert(new)
    after = table._manifest()["current"]
    assert {int(b) for b in after if after[b] != before.get(b)} == touched and len(spoiled) > 0
    for f, content in kept.items():
        f.write_bytes(content)
    rows = {r.k: r.v for r in table.read().collect()}
    assert len(rows) == 401 and rows["7"] == rows["new"] == 1 and sum(rows.values()) == 2


def test_a_write_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    one = table.replace(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"))

    def fails(*_):
        raise OSError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(buckets_module, "write_text", fails)
        with pytest.raises(OSError):
            table.upsert(spark.createDataFrame([("a", 2)], "k string, v int"))
    assert rows_of(table.read()) == rows_of(one)
    for v in (3, 4, 5):
        table.upsert(spark.createDataFrame([("a", v)], "k string, v int"))
        table.drop_old(keep=2)
    assert {r.k: r.v for r in table.read().collect()} == {"a": 5, "b": 1}
    assert len(list(Path(table.path).glob("version=*"))) <= 3 and len(table._numbers()) == 2


def test_a_table_kept_whole_is_taken_over(spark, tmp_path):
    whole = VersionedTable(spark, str(tmp_path / "t"))
    whole.replace(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"))
    table = BucketedTable(spark, whole.path, ["k"], buckets=4)
    assert {r.k: r.v for r in table.upsert(spark.createDataFrame([("b", 3)], "k string, v int")).collect()} == {"a": 1, "b": 3}
    assert not BucketedTable(spark, str(tmp_path / "none"), ["k"]).exists()


def test_statistics_of_many_runs_stay_in_few_files(spark, tmp_path):
    path = str(tmp_path / "stats")
    for i in range(70):
        record = {"run_id": f"run_{i}", "run_timestamp": datetime(2024, 1, 1), "source_filename": "all_files", "stage_name": "upload", "rows_input": i}
        append_stats(stats_rows(spark, [record]).coalesce(1), path)
    assert len(list(Path(path).rglob("*.parquet"))) <= 33
    assert sorted(r.rows_input for r in read_stats(spark, path).collect()) == list(range(70))


def test_packing_days(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "n long"
    for i in range(6):
        days = spark.createDataFrame([(i, date(2024, 1, 1)), (i, None), *([(i, date(2024, 1, 2))] if i == 0 else [])], "n long, d date")
        days.coalesce(1).write.mode("append").partitionBy("d").parquet(path)
    want = rows_of(spark.read.schema("n long, d date").parquet(path))
    kind = spark.createDataFrame([], schema).schema
    assert compact_days(spark, path, "d", kind, most_files=3) == 2
    assert rows_of(spark.read.schema("n long, d date").parquet(path)) == want
    assert len(list(Path(path).rglob("*.parquet"))) == 3
    assert compact_days(spark, path, "d", kind, most_files=3) == 0
    (tmp_path / "t" / "d=2024-01-02").rename(tmp_path / "t" / "_before.d=2024-01-02")
    mend_days(spark, path)
    assert rows_of(spark.read.schema("n long, d date").parquet(path)) == want


def test_ledger(spark, tmp_path):
    ledger = BatchLedger(spark, str(tmp_path / "t"), "run/1 ü")
    assert ledger.find(3) is None
    ledger.enter(3, LoadCounts(5, 2))
    assert ledger.find(3) == LoadCounts(5, 2) and BatchLedger(spark, str(tmp_path / "t"), "run").find(3) is None


def test_a_batch_delivered_again_is_not_read(spark, tmp_path, monkeypatch):
    from wattline.sources.facts import FactTable
    from wattline.streaming import arrivals

    raw, target, stats = tmp_path / "raw", str(tmp_path / "t"), str(tmp_path / "stats")
    raw.mkdir()
    (raw / "one.csv").write_text("METER_ID,DATA_TIME,IMPORT_ACTIVE_POWER\n1,2024-01-01 00:00:00,5\n1,2024-01-01 00:00:00,7\n,2024-01-01 00:00:00,1\n,2024-01-01 00:00:00,1\n")

    def deliver(checkpoint, recompute=None):
        files = arriving_files(spark, str(raw))
        start_loading(files, target, str(tmp_path / checkpoint), run_id="r", stats_path=stats, recompute=recompute).awaitTermination()

    def breaks(*_):
        raise OSError("lost")

    # the rows are written, the ledger is not: the next delivery loads again and adds nothing
    with monkeypatch.context() as patch:
        patch.setattr(BatchLedger, "enter", breaks)
        with pytest.raises(Exception):
            deliver("a")
    assert FactTable(spark, target).read().count() == 3
    deliver("b")
    assert FactTable(spark, target).read().count() == 3
    # entered: no file is opened any more
    monkeypatch.setattr(arrivals, "load_files", breaks)
    deliver("c")
    told = read_stats(spark, stats).collect()
    assert [(r.rows_input, r.source_filename) for r in told] == [(4, "batch_0")]
