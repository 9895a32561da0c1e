"""A table in hash buckets of its key, of which an update rewrites only those it touches."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.sources.facts import united
from wattline.sources.scratch import written
from wattline.sources.tables import VersionedTable, _fs, delete_path, path_exists, read_text, write_text

BUCKETS = 64
MANIFESTS = "_manifest"
BUCKET = "key_bucket"


class BucketedTable:
    """Rows in ``buckets`` folders by a hash of their key; the newest manifest names the version that counts of each.

    An update writes the touched buckets under a new version and then a new manifest, so it is there as a whole or not at
    all, and readers of the manifest before are not disturbed. A lost job leaves folders that no manifest names. One writer at a
    time. A table kept whole in versions at the same place is taken over by the first use. The number of buckets stays as the
    table was built with; a bucket should be a few files' worth.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets

    def _numbers(self) -> list[int]:
        folder = f"{self.path}/{MANIFESTS}"
        if not path_exists(self.spark, folder):
            return []
        fs, root = _fs(self.spark, folder)
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def _manifest(self, number: int | None = None) -> dict:
        """schema, buckets (their number), and current: the version by bucket."""
        number = number or self._numbers()[-1]
        return json.loads(read_text(self.spark, f"{self.path}/{MANIFESTS}/{number:08d}.json"))

    def exists(self) -> bool:
        if self._numbers():
            return True
        whole = VersionedTable(self.spark, self.path)
        if not whole.exists():
            return False
        self.replace(whole.read())
        return True

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(buckets)).cast("int")

    def read(self, only: list[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets."""
        if not self.exists():
            raise FileNotFoundError(f"no table under {self.path}")
        manifest = self._manifest()
        schema = T.StructType.fromJson(manifest["schema"])
        paths = [f"{self.path}/version={v}/{BUCKET}={b}" for b, v in manifest["current"].items() if only is None or int(b) in only]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, rows: DataFrame, schema: T.StructType, buckets: int, current: dict[str, int]) -> DataFrame:
        """Write these rows' buckets as the next version and name them in the next manifest."""
        taken = [0, *self._numbers()]
        if path_exists(self.spark, self.path):
            fs, root = _fs(self.spark, self.path)
            names = [s.getPath().getName() for s in fs.listStatus(root)]
            taken += [int(n.removeprefix("version=")) for n in names if n.startswith("version=")]
        version = max(taken) + 1
        folder = f"{self.path}/version={version}"
        rows.withColumn(BUCKET, self._bucket(buckets)).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(folder)
        fs, root = _fs(self.spark, folder)
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        fresh = {n.removeprefix(f"{BUCKET}="): version for n in names if n.startswith(f"{BUCKET}=")}
        manifest = {"schema": schema.jsonValue(), "buckets": buckets, "current": {**current, **fresh}}
        write_text(self.spark, f"{self.path}/{MANIFESTS}/{version:08d}.json", json.dumps(manifest))
        return self.read()

    def replace(self, df: DataFrame) -> DataFrame:
        """Build the table anew."""
        return self._write(df, united(T.StructType(), df.schema), self.buckets, {})

    def upsert(self, new: DataFrame) -> DataFrame:
        """New rows replace old rows of the same key (nulls are no key and replace nothing); other old rows stay. Columns only one
        side has are kept, null for the other side's rows. Only the buckets of the new rows' keys are read and written; which
        these are, a short list, is all that reaches the driver."""
        if not self.exists():
            return self.replace(new)
        manifest = self._manifest()
        schema = united(T.StructType.fromJson(manifest["schema"]), new.schema)
        new = written(new, "upsert")
        touched = [row[0] for row in new.select(self._bucket(manifest["buckets"])).distinct().collect()]
        if not touched:
            return self.read()
        kept = self.read(touched).join(new.select(*self.keys).distinct(), self.keys, "left_anti")
        merged = kept.unionByName(new, allowMissingColumns=True)
        merged = merged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        return self._write(merged, schema, manifest["buckets"], manifest["current"])

    def drop_old(self, keep: int = 2) -> None:
        """Delete all but the newest manifests, and what no manifest names any more."""
        numbers = self._numbers()
        for number in numbers[:-keep]:
            delete_path(self.spark, f"{self.path}/{MANIFESTS}/{number:08d}.json")
        named = {(int(v), b) for n in numbers[-keep:] for b, v in self._manifest(n)["current"].items()}
        fs, root = _fs(self.spark, self.path)
        for folder in fs.listStatus(root):
            name = folder.getPath().getName()
            if not name.startswith("version="):
                continue
            version = int(name.removeprefix("version="))
            buckets = [s.getPath().getName().removeprefix(f"{BUCKET}=") for s in fs.listStatus(folder.getPath()) if s.isDirectory()]
            for bucket in buckets:
                if (version, bucket) not in named:
                    delete_path(self.spark, f"{self.path}/{name}/{BUCKET}={bucket}")
            if not any(v == version for v, _ in named):
                delete_path(self.spark, f"{self.path}/{name}")
