"""Compare a Spark result with the same result in SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def _rows(frame: pd.DataFrame) -> list[tuple]:
    def plain(value):
        if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
            return "null"
        if hasattr(value, "isoformat"):
            return pd.Timestamp(value).isoformat()
        if isinstance(value, bool) or type(value).__name__ == "bool_":
            return str(bool(value))
        if isinstance(value, (int, float)) or type(value).__module__ == "numpy":
            return repr(float(value))
        if type(value).__name__ == "Decimal":
            return repr(float(value))
        return str(value)

    columns = sorted(frame.columns)
    return sorted(tuple(plain(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False, name=None))


def differences(spark_frame, sql: str, con) -> str | None:
    got = spark_frame.toPandas()
    want = con.sql(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(set(got.columns) ^ set(want.columns))}"
    a, b = _rows(got), _rows(want)
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} of {len(a)} rows differ, first {sorted(got.columns)} {wrong[0]}" if wrong else None
