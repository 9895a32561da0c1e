"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


BATCH_BYTES = 8 << 20


def keep_batches_small(spark: SparkSession) -> None:
    """Bound the batches that go to Python by bytes: by rows alone, long texts would fill a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def crc_part(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


def row_key(doc_id: str, text: str) -> Column:
    """A hash of id and text that stands for a row; rows that repeat both share it."""
    return F.xxhash64(F.col(doc_id).cast("long").cast("string"), F.col(text).cast("string"))


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def small_batches(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``max_bytes`` of text each (a longer single text is a slice of its own)."""
    for batch in batches:
        column = batch.column(text)
        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)
