"""Parquet tables: plain, day-partitioned facts, and small tables replaced version by version."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MAX_ROWS_PER_FILE = 20_000_000


class EmptyOutput(RuntimeError):
    """A write that had to produce rows produced none."""


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists and holds something besides marker files."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(hadoop_path))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.delete(hadoop_path, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file's content."""
    fs, file = _fs(spark, path)
    stream = fs.open(file)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, written aside and renamed, so that it is there as a whole or not at all."""
    folder, name = path.rsplit("/", 1)
    fs, aside = _fs(spark, f"{folder}/.{name}")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(aside, _fs(spark, path)[1]):
        raise OSError(f"cannot write {path}")


def read_parquet_tree(spark: SparkSession, path: str, merge: bool = False) -> DataFrame:
    """Every Parquet file below a folder; ``merge`` unites differing columns, reading every footer."""
    return spark.read.option("recursiveFileLookup", True).option("mergeSchema", merge).parquet(path)


REJECTED = "_rejected"


def write_quarters(clean: DataFrame, path: str, compression: str = "snappy", row_group_bytes: int | None = None) -> None:
    """Clean readings, one folder per quarter (rows without a time go to the null folder), in place of what the
    folder held: a repeated run writes the same again. Rows marked in a column ``rejected`` go to a folder of their own.

    Written straight from the scan, without a shuffle: input files cover few quarters each, so a
    task opens few output files, and a quarter holding most rows is written by many tasks.
    """
    folder = F.col("QUARTER")
    if "rejected" in clean.columns:
        folder = F.when(F.col("rejected"), REJECTED).otherwise(folder)
    writer = (
        clean.withColumn("quarter_folder", folder)
        .drop("rejected")
        .write.mode("overwrite")
        .partitionBy("quarter_folder")
        .option("compression", compression)
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
    )
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def read_quarters(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """The clean readings of a run, without the folder of rejected rows; with ``rejects`` all rows, marked in a column ``rejected``."""
    rows = spark.read.parquet(path).withColumn("rejected", F.coalesce(F.col("quarter_folder").cast("string") == REJECTED, F.lit(False)))
    rows = rows.drop("quarter_folder")
    return rows if rejects else rows.where(~F.col("rejected")).drop("rejected")


def publish(spark: SparkSession, built: str, path: str) -> None:
    """Put a finished folder in the place of ``path``. What stood there is moved aside, then deleted; a run that breaks off in between
    leaves it aside, from where ``recover`` brings it back."""
    recover(spark, path)
    fs, target = _fs(spark, path)
    aside = _fs(spark, _aside(path))[1]
    fs.mkdirs(target.getParent())
    if fs.exists(target) and not fs.rename(target, aside):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(_fs(spark, built)[1], target):
        raise OSError(f"cannot move {built} to {path}")
    fs.delete(aside, True)


def recover(spark: SparkSession, path: str) -> None:
    """Bring back what a ``publish`` that broke off had moved aside; delete it if the new folder is in place."""
    fs, target = _fs(spark, path)
    aside = _fs(spark, _aside(path))[1]
    if fs.exists(aside):
        if fs.exists(target):
            fs.delete(aside, True)
        elif not fs.rename(aside, target):
            raise OSError(f"cannot bring back {path}")


def _aside(path: str) -> str:
    folder, name = path.rstrip("/").rsplit("/", 1)
    return f"{folder}/_before.{name}"


def write_by_day(
    df: DataFrame, path: str, day: str, cluster_by: list[str], mode: str = "append", only_its_days: bool = False
) -> int:
    """Fact rows in one folder per day, clustered inside files; returns the number of rows written.

    With mode ``overwrite``, ``only_its_days`` leaves the folders of other days alone. The rebalance keeps files large and splits a day that holds most rows over several tasks. The
    count is taken in the stage that writes, where a retried task counts once.
    """
    written = Observation()
    (
        df.hint("rebalance", day)
        .sortWithinPartitions(day, *cluster_by)
        .observe(written, F.count("*").alias("n"))
        .write.mode(mode)
        .partitionBy(day)
        .option("partitionOverwriteMode", "dynamic" if only_its_days else "static")
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .parquet(path)
    )
    return written.get["n"]


class VersionedTable:
    """A small table that may be rebuilt from its own content.

    Every write goes to a new ``version=N`` folder; the newest folder with the job's ``_SUCCESS``
    marker is the table. A lost job leaves a folder without marker, which nobody reads. One writer
    at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _versions(self) -> list[int]:
        fs, root = _fs(self.spark, self.path)
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
        return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def _committed(self) -> list[int]:
        return [v for v in self._versions() if path_exists(self.spark, f"{self._folder(v)}/_SUCCESS")]

    def exists(self) -> bool:
        return bool(self._committed())

    def read(self) -> DataFrame:
        committed = self._committed()
        if not committed:
            raise FileNotFoundError(f"no finished version under {self.path}")
        return self.spark.read.parquet(self._folder(committed[-1]))

    def replace(self, df: DataFrame) -> DataFrame:
        """Write the next version and make it current."""
        existing = self._versions()
        df.write.parquet(self._folder(existing[-1] + 1 if existing else 1))
        return self.read()

    def clear(self) -> None:
        """Delete all versions."""
        delete_path(self.spark, self.path)

    def drop_old(self, keep: int = 2) -> None:
        """Delete all but the newest finished versions."""
        for version in self._committed()[:-keep]:
            delete_path(self.spark, self._folder(version))


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Full rebuild of a table. Readers keep the version before until the new one is complete; the one before that goes."""
    table = VersionedTable(df.sparkSession, path)
    rebuilt = table.replace(df)
    table.drop_old(keep=2)
    return rebuilt


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table written by ``replace_table``."""
    return VersionedTable(spark, path).read()
