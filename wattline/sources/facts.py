"""The day-partitioned fact table: one recorded schema that every batch is fitted to, and its files by day."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.sources.tables import _fs, delete_path, has_data, path_exists, publish, read_text, recover, write_text

SCHEMA_FOLDER = "_table_schema"  # the underscore hides it from scans
NO_DAY = "__HIVE_DEFAULT_PARTITION__"

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_REAL = [T.FloatType(), T.DoubleType()]


class SchemaConflict(ValueError):
    """A batch's column cannot be kept in the table's column of that name."""


def wider(name: str, known: T.DataType, new: T.DataType) -> T.DataType:
    """The type that holds both without loss and that a scan can read from files of either."""
    if known == new or isinstance(new, T.NullType):
        return known
    if isinstance(known, T.NullType):
        return new
    for kinds in (_WHOLE, _REAL):
        if known in kinds and new in kinds:
            return max(known, new, key=kinds.index)
    for small, large in ((known, new), (new, known)):
        if small in _WHOLE[:3] and large == T.DoubleType():
            return large
    raise SchemaConflict(f"{name} is {known.simpleString()} in the table and {new.simpleString()} in the batch")


def united(known: T.StructType, new: T.StructType) -> T.StructType:
    """The table's columns, widened where the batch needs it, then the batch's further ones. Names match in any case, as in
    Spark; the first spelling stays."""
    fields = {f.name.lower(): T.StructField(f.name, f.dataType) for f in known}
    for f in new:
        old = fields.get(f.name.lower())
        kind = f.dataType if old is None else wider(f.name, old.dataType, f.dataType)
        fields[f.name.lower()] = T.StructField(old.name if old else f.name, T.StringType() if isinstance(kind, T.NullType) else kind)
    return T.StructType(list(fields.values()))


class FactTable:
    """Parquet files in one folder per day, read through a recorded schema.

    Files written before a column was known lack it; files of a batch that lacked a known column hold it as null. Read
    without the record, Spark would take the schema of any one file. The record is a numbered JSON file below the table,
    written before the rows that need it; the highest number counts. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, day: str = "reading_date"):
        self.spark, self.path, self.day = spark, path.rstrip("/"), day

    def exists(self) -> bool:
        return has_data(self.spark, self.path)

    def _records(self) -> list[int]:
        folder = f"{self.path}/{SCHEMA_FOLDER}"
        if not path_exists(self.spark, folder):
            return []
        fs, root = _fs(self.spark, folder)
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def schema(self) -> T.StructType:
        """The recorded columns, without the day. A table from before there was a record is read through all its footers."""
        records = self._records()
        if not records:
            if not self.exists():
                return T.StructType()
            found = self.spark.read.option("mergeSchema", True).parquet(self.path).schema
            return T.StructType([f for f in found if f.name != self.day])
        return T.StructType.fromJson(json.loads(read_text(self.spark, f"{self.path}/{SCHEMA_FOLDER}/{records[-1]:08d}.json")))

    def _record(self, schema: T.StructType) -> None:
        number = (self._records() or [0])[-1] + 1
        write_text(self.spark, f"{self.path}/{SCHEMA_FOLDER}/{number:08d}.json", schema.json())

    def admit(self, batch: T.StructType) -> T.StructType:
        """Extend the recorded schema by a batch's columns and return it."""
        own = T.StructType([f for f in batch if f.name != self.day])
        known = self.schema()
        schema = united(known, own)
        if schema != known or not self._records():
            self._record(schema)
        return schema

    def fitted(self, rows: DataFrame) -> DataFrame:
        """A batch with exactly the recorded columns and the day: absent ones are null."""
        there = {c.lower(): c for c in rows.columns}
        columns = [
            (F.col(there[f.name.lower()]) if f.name.lower() in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema()
        ]
        return rows.select(*columns, self.day)

    def read(self) -> DataFrame:
        """All rows, every recorded column and the day."""
        if not self.exists():
            raise FileNotFoundError(f"no facts under {self.path}")
        schema = T.StructType([*self.schema(), T.StructField(self.day, T.DateType())])
        return self.spark.read.schema(schema).parquet(self.path)


def day_files(spark: SparkSession, path: str, day: str) -> DataFrame:
    """(day, path, length, modificationTime) of the Parquet files of a table by day, from the listing alone: no file is opened."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
    value = F.regexp_extract("path", f"/{day}=([^/]+)/", 1)
    return listed.select(F.when(value != NO_DAY, F.to_date(value)).alias(day), "path", "length", "modificationTime")


def compact_days(spark: SparkSession, path: str, day: str, schema: T.StructType, most_files: int = 32, file_bytes: int = 128 << 20) -> int:
    """Pack the files of days that hold more than ``most_files`` and could do with half of them; returns the number of days packed.

    All such days are read and written by one job, then each folder takes the place of the old one by a rename, as ``publish`` does; a
    run that breaks off is mended by the next. The files of a packed day count as changed. One writer at a time.
    """
    mend_days(spark, path)
    listed = day_files(spark, path, day).groupBy(day).agg(F.count("*").alias("n"), F.sum("length").alias("bytes"))
    crowded = listed.where((F.col("n") > most_files) & (F.col("n") >= 2 * F.ceil(F.col("bytes") / file_bytes)))
    days = [row[0] for row in crowded.select(day).collect()]  # one short row per calendar day
    if not days:
        return 0
    dated = [d for d in days if d is not None]
    wanted = F.col(day).isin(dated) if dated else F.lit(False)
    rows = spark.read.schema(T.StructType([*schema, T.StructField(day, T.DateType())])).parquet(path)
    rows = rows.where(wanted | F.col(day).isNull() if len(dated) < len(days) else wanted)
    aside = f"{path.rstrip('/')}/_packing"
    rows.hint("rebalance", day).write.mode("overwrite").partitionBy(day).parquet(aside)
    for value in days:
        folder = f"{day}={NO_DAY if value is None else value}"
        publish(spark, f"{aside}/{folder}", f"{path.rstrip('/')}/{folder}")
    delete_path(spark, aside)
    return len(days)


def mend_days(spark: SparkSession, path: str) -> None:
    """Bring back the day folders that a packing which broke off had moved aside."""
    fs, root = _fs(spark, path)
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("_before."):
            recover(spark, f"{path.rstrip('/')}/{name.removeprefix('_before.')}")
