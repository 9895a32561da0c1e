"""Table checks. Each returns the violations; an empty frame means the check passed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class CheckFailed(ValueError):
    """A table check found violations."""


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by several rows, with the number of rows; keys containing a null are not compared."""
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    return df.where(complete).groupBy(*keys).agg(F.count("*").alias("n_records")).where("n_records > 1")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns holding nulls, with the number of them; one pass over the table."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "n_nulls").where("n_nulls > 0")


def table_checks(clean: DataFrame, consumption: DataFrame, daily: DataFrame) -> DataFrame:
    """The standing checks of the clean, consumption and daily tables: one row per check with the
    number of violations (repeated keys, or nulls). Repeated row hashes are possible by design, as
    copies inside one load are kept."""

    results = [
        *_results("clean", clean, ["ROW_HASH"], ["ROW_HASH", "METER_ID", "DATA_TIME"]),
        *_results("consumption", consumption, ["meter_id"]),
        *_results("daily", daily, ["meter_id", "date"]),
    ]
    return reduce(DataFrame.unionByName, results)


def _results(name: str, df: DataFrame, keys: list[str], present: list[str] | None = None) -> list[DataFrame]:
    """Violations of one key's uniqueness, and nulls in the columns that must be present (the key's, unless given)."""
    repeated = duplicate_keys(df, keys).agg(F.count("*").alias("n_violations"))
    columns = keys if present is None else present
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).unpivot([], columns, "column_name", "n_violations")
    return [
        repeated.select(F.lit(f"{name}.unique.{'.'.join(keys).lower()}").alias("check_name"), "*"),
        nulls.select(F.concat(F.lit(f"{name}.not_null."), F.lower("column_name")).alias("check_name"), "n_violations"),
    ]


def fact_checks(facts: DataFrame, day: str) -> DataFrame:
    """Per day of the fact table the state of its checks: repeated keys (meter and time), and nulls by column. A reading's key contains its
    time, so copies never cross days and the table's result is the sum over its days."""
    by_key = facts.groupBy(day, "METER_ID", "DATA_TIME").agg(F.count("*").alias("n"), F.count_if(F.col("ROW_HASH").isNull()).alias("no_hash"))
    complete = F.col("METER_ID").isNotNull() & F.col("DATA_TIME").isNotNull()

    def lacking(column: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(column).isNull(), F.col("n"))), F.lit(0)).alias(f"no_{column.lower()}")

    return by_key.groupBy(day).agg(
        F.count_if(complete & (F.col("n") > 1)).alias("repeated_keys"),
        F.sum("no_hash").alias("no_row_hash"),
        lacking("METER_ID"),
        lacking("DATA_TIME"),
    )


def run_checks(days: DataFrame, consumption: DataFrame, daily: DataFrame) -> DataFrame:
    """The standing checks of a run: one row per check with the number of violations. Those of the facts follow from the
    states of ``fact_checks``, so only days that changed are looked at again."""
    names = {
        "repeated_keys": "readings.unique.meter_id.data_time",
        "no_row_hash": "readings.not_null.row_hash",
        "no_meter_id": "readings.not_null.meter_id",
        "no_data_time": "readings.not_null.data_time",
    }
    summed = days.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(name) for c, name in names.items()])
    facts = summed.unpivot([], [F.col(f"`{name}`") for name in names.values()], "check_name", "n_violations")
    return facts.unionByName(reduce(DataFrame.unionByName, [*_results("consumption", consumption, ["meter_id"]), *_results("daily", daily, ["meter_id", "date"])]))


def require_none(violations: DataFrame, message: str) -> None:
    """Raise if there is any violation, showing a few."""
    some = violations.limit(5).collect()
    if some:
        raise CheckFailed(f"{message}: {[row.asDict() for row in some]}")
