"""Files that keep arriving, loaded as they come."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict
from datetime import datetime
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattline.operators.loading import LoadCounts, insert_if_absent
from wattline.operators.staging import keep_first
from wattline.sources.delimited import Resolver, file_columns, read_readings, with_derived
from wattline.sources.runlog import append_records, read_stats
from wattline.sources.scratch import scratch_area, written
from wattline.sources.tables import path_exists, read_text, write_text

LISTING_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def arriving_files(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.csv",
    max_files_per_batch: int | None = None,
    recursive: bool = False,
) -> DataFrame:
    """A stream of new files, each seen once. Only names and sizes travel; contents are not read here."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(LISTING_SCHEMA)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", recursive)
    )
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return file_columns(reader.load(folder))


def one_row_per_key(clean: DataFrame) -> DataFrame:
    """One row per meter and minute, highest power first, so the choice does not depend on file order. Rows lacking
    meter or time have no key to be copies by and all stay, as in a batch load. Rows are sorted by a hash of the key first: whole
    numbers compare at once, ids and times of one meter hardly differ in their first bytes."""
    power, has_key = F.col("IMPORT_ACTIVE_POWER").desc_nulls_last(), F.col("METER_ID").isNotNull() & F.col("DATA_TIME").isNotNull()
    marked = clean.withColumn("_own", F.when(~has_key, F.monotonically_increasing_id()))  # each is a key of its own
    keys = ["METER_ID", "DATA_TIME", "_own"]
    return keep_first(marked.withColumn("_hash", F.xxhash64(*keys)), ["_hash", *keys], [power, F.col("source_filename")]).drop("_hash", "_own")


def load_files(
    files: DataFrame, target: str, *, resolver: Resolver | None = None, on_reject: str = "fail", keys: list[str] | None = None
) -> LoadCounts | None:
    """Read, harmonise and load one set of files; loading the same set again adds nothing. Copies inside the set
    count as skipped. The files are parsed once, and what they hold is written once before it is compared with the target. Time
    text, quarter and hash follow from the key and are derived for the rows that stay."""
    with scratch_area(files.sparkSession):
        typed, _ = read_readings(files.sparkSession, files, resolver=resolver, on_reject=on_reject, derived=False)
        arrived = Observation()
        unique = written(with_derived(one_row_per_key(typed.observe(arrived, F.count("*").alias("n")))), "unique")
        if not arrived.get["n"]:
            return None
        counts = insert_if_absent(files.sparkSession, unique, target, keys)
        return LoadCounts(arrived.get["n"], counts.rows_inserted)


class BatchLedger:
    """Which batches of which run a table holds: a small file per batch below the table, written when its rows are.

    A batch that is delivered again is known from here before any of its files is opened. One whose load broke off before it was
    entered is loaded again, which adds nothing that is there already.
    """

    def __init__(self, spark: SparkSession, target: str, run_id: str):
        self.spark, self.folder = spark, f"{target.rstrip('/')}/_batches/{quote(run_id, safe='')}"

    def _entry(self, batch_id: int) -> str:
        return f"{self.folder}/{batch_id:012d}.json"

    def find(self, batch_id: int) -> LoadCounts | None:
        """What the batch's load counted; None if it is not entered."""
        if not path_exists(self.spark, self._entry(batch_id)):
            return None
        return LoadCounts(**json.loads(read_text(self.spark, self._entry(batch_id))))

    def enter(self, batch_id: int, counts: LoadCounts) -> None:
        write_text(self.spark, self._entry(batch_id), json.dumps(asdict(counts)))


def start_loading(
    files: DataFrame,
    target: str,
    checkpoint: str,
    *,
    run_id: str,
    stats_path: str | None = None,
    resolver: Resolver | None = None,
    on_reject: str = "fail",
    keys: list[str] | None = None,
    poll_seconds: int | None = None,
    recompute: Callable[[SparkSession], object] | None = None,
) -> StreamingQuery:
    """Load every arriving file. Without ``poll_seconds`` it takes what is there and stops. ``recompute`` runs after each
    batch that added rows, e.g. ``readings_to_models`` with its incremental rules.

    A batch that is repeated after a failure is known from the target's ledger and not read again; if the load itself broke
    off, its keys are found in the target and nothing is inserted twice. Its statistics row, named after run and batch, is
    written once.
    """

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ledger = BatchLedger(spark, target, run_id)
        counts = ledger.find(batch_id)
        if counts is None:
            counts = load_files(batch, target, resolver=resolver, on_reject=on_reject, keys=keys)
            ledger.enter(batch_id, counts or LoadCounts(0, 0))
        if counts is None or not counts.rows_input:
            return
        # also for a batch that was entered: what follows may have broken off
        if recompute is not None and counts.rows_inserted:
            recompute(spark)
        if stats_path is None:
            return
        name = f"batch_{batch_id}"
        recorded = read_stats(spark, stats_path).where((F.col("run_id") == run_id) & (F.col("source_filename") == name))
        if recorded.isEmpty():
            record = {
                "run_id": run_id,
                "run_timestamp": datetime.now(),
                "source_filename": name,
                "stage_name": "upload",
                "rows_input": counts.rows_input,
                "rows_output": counts.rows_inserted,
                "rows_filtered": counts.rows_skipped,
                "rows_duplicates_skipped": counts.rows_skipped,
                "filter_reason": "duplicate_row_hash" if counts.rows_skipped else None,
            }
            append_records(spark, [record], stats_path)

    trigger = {"availableNow": True} if poll_seconds is None else {"processingTime": f"{poll_seconds} seconds"}
    return (
        files.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
