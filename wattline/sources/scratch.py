"""Intermediate tables in the shared folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from wattline.sources.tables import delete_path

SETTING = "spark.checkpoint.dir"

_area: ContextVar[str | None] = ContextVar("scratch_area", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The session's shared folder. Only a local session may fall back to a folder of its own."""
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    return _own_folder(context.applicationId)


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="wattline-")


def scratch_path(spark: SparkSession, label: str) -> str:
    base = _area.get() or f"{scratch_root(spark)}/wattline/{spark.sparkContext.applicationId}"
    return f"{base}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_area(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside the block are deleted at its end, so frames that read them
    must be used up by then."""
    path = scratch_path(spark, "area")
    token = _area.set(path)
    try:
        yield
    finally:
        _area.reset(token)
        delete_path(spark, path)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: cuts the lineage, survives lost executors, gives real size statistics."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
