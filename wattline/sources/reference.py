"""Reference tables from CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.sources.tables import replace_table
from wattline.spec import SCHEDULE_CSV_SCHEMA, SITES_CSV_SCHEMA


def read_schedule(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEDULE_CSV_SCHEMA).option("header", True).csv(path)


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SITES_CSV_SCHEMA).option("header", True).csv(path)


_DROPPED = str.maketrans({" ": "_", "(": None, ")": None})


def normal_header(name: str) -> str:
    """A sheet's header as a column name: outer white space off, inner blanks as underscores, parentheses away,
    capitals."""
    inner = name.strip()
    return inner.translate(_DROPPED).upper()


def with_normal_headers(df: DataFrame) -> DataFrame:
    """The same columns under normal names."""
    return df.toDF(*map(normal_header, df.columns))


def load_reference(spark: SparkSession, csv_path: str, table_path: str) -> DataFrame:
    """Replace a reference table by a CSV sheet with inferred types and a load time.

    Inference reads the sheet twice, which is fine for sheets; readings never go through here.
    """
    sheet = spark.read.option("header", True).option("inferSchema", True).csv(csv_path)
    return replace_table(with_normal_headers(sheet).withColumn("_LOADED_AT", F.current_timestamp()), table_path)
