"""Incremental loads: insert-if-absent, keyed upsert, and what has to be recomputed."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.operators.joins import MAX_BROADCAST_BYTES, join_per_key, possible_matches
from wattline.sources.buckets import BucketedTable
from wattline.sources.facts import FactTable
from wattline.sources.scratch import written
from wattline.sources.tables import EmptyOutput, VersionedTable, write_by_day

log = logging.getLogger(__name__)

DAY = "reading_date"
MAX_DAY_LIST = 2_000


@dataclass(frozen=True)
class LoadCounts:
    rows_input: int
    rows_inserted: int

    @property
    def rows_skipped(self) -> int:
        return self.rows_input - self.rows_inserted


def absent_rows(batch: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the batch whose key the target lacks; copies inside the batch stay. Nulls in a key are equal."""
    known = target.select(*[F.col(k).alias(f"_known_{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_known_{i}")) for i, k in enumerate(keys)]
    return batch.join(known, reduce(lambda a, b: a & b, same), "left_anti")


def _same_days(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The part of a day-partitioned target that can hold keys of the batch.

    Only rows of one day are compared (see ``insert_if_absent``); this spares the scan the folders of other days
    at planning time, by a list of days or, for batches over very many, by their range.
    """
    days = batch.select(DAY).distinct().limit(MAX_DAY_LIST + 1).collect()
    known = [row[0] for row in days if row[0] is not None]
    wanted = F.col(DAY).isin(known) if known else F.lit(False)
    undated = any(row[0] is None for row in days)
    if len(days) > MAX_DAY_LIST:
        low, high = batch.agg(F.min(DAY), F.max(DAY)).first()
        wanted, undated = F.col(DAY).between(F.lit(low), F.lit(high)), True
    return target.where(wanted | F.col(DAY).isNull() if undated else wanted)


def insert_if_absent(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    keys: list[str] | None = None,
    time: str = "DATA_TIME",
) -> LoadCounts:
    """Append the rows of a batch whose key is not in the day-partitioned target yet.

    Existing rows are never changed. Copies inside one batch are kept, as is everything on the
    first load and everything in a batch without the key columns. The table's recorded columns grow by those of the batch;
    columns the batch lacks are null in its rows. Only the target's folders for
    the batch's days are read; of their keys only those that a bounded filter of the batch's keys lets through are
    made distinct and shuffled for the join, and a key with very many batch rows is left to the runtime skew split. Keys are
    compared within one day, nulls being equal: chance matches of hashes across days cannot lose a reading.
    The inserted rows are counted in the stage that writes, where a retried task counts once.
    """
    keys = ["ROW_HASH"] if keys is None else keys
    rows = batch if DAY in batch.columns else batch.withColumn(DAY, F.to_date(time))
    rows_input = rows.count()
    if rows_input == 0:
        raise EmptyOutput("the batch holds no rows")
    facts, there = FactTable(spark, path, DAY), {c.lower() for c in rows.columns}
    known, loaded = {f.name.lower() for f in facts.schema()}, facts.exists()
    facts.admit(rows.schema)
    rows = facts.fitted(rows)
    fresh, cluster_by = rows, [k for k in keys if k.lower() in there]
    if len(cluster_by) < len(keys):
        log.warning("key columns %s are not in the batch: appending all rows to %s", keys, path)
    elif loaded and known >= {k.lower() for k in keys}:
        both = [DAY, *[k for k in keys if k != DAY]]
        near = possible_matches(_same_days(facts.read(), rows).select(*both), rows.select(*both), both)
        fresh = absent_rows(rows, near.distinct(), both)
    inserted = write_by_day(fresh, path, DAY, cluster_by)
    return LoadCounts(rows_input, inserted)


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace old rows of the same key; other old rows stay, also if no longer derived.

    Columns only one side has are kept, null for the other side's rows.
    """
    kept = old.join(new.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def upsert(table: VersionedTable | BucketedTable, new: DataFrame, keys: list[str]) -> DataFrame:
    """Apply ``upserted`` to a table; the first run is a full build. The new rows are computed once: they are
    written before their keys are held against the old ones. A bucketed table rewrites only the buckets of their keys."""
    if isinstance(table, BucketedTable):
        if table.keys != keys:
            raise ValueError(f"the table's buckets are by {table.keys}")
        return table.upsert(new)
    if not table.exists():
        return table.replace(new)
    return table.replace(upserted(table.read(), written(new, "upsert"), keys))


def high_water_mark(result: DataFrame) -> DataFrame:
    """Latest covered date over all meters, as one row; 1900-01-01 for an empty result."""
    latest = F.coalesce(F.max("max_reading_date"), F.to_date(F.lit("1900-01-01")))
    return result.agg(latest.alias("high_water_mark"))


def changed_meters(readings: DataFrame, result: DataFrame) -> DataFrame:
    """Meters with a reading dated after the latest date covered by ``result``.

    The date is global: a late reading for a covered date does not count until its meter gets a
    newer day.
    """
    newer = F.col("reading_date") > high_water_mark(result).scalar()
    return readings.where(newer).select("meter_id").distinct()


def readings_of_changed_meters(
    readings: DataFrame, result: DataFrame, *, spread: str = "reading_at", max_broadcast_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """All readings (or days), old and new, of the changed meters. The meter list is written once: it is
    counted to choose the join, then joined."""
    return join_per_key(
        readings,
        written(changed_meters(readings, result), "changed"),
        ["meter_id"],
        "left_semi",
        F.col(spread),
        max_broadcast_bytes=max_broadcast_bytes,
    )


def new_pairs(consumption: DataFrame, recorded: DataFrame) -> DataFrame:
    """Consumption rows whose (meter, quarter) is not recorded; recorded pairs are never refreshed."""
    return consumption.join(recorded.select("meter_id", "quarter"), ["meter_id", "quarter"], "left_anti")
