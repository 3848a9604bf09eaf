"""Compare Spark results with SQL results, row for row."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, decimal.Decimal):
        return str(value)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when names, types that print differently, rows and their multiplicity all agree."""
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(names) != sorted(spark_result.columns):
        return [f"columns {sorted(spark_result.columns)} != {sorted(names)}"]
    expected = rows_of(names, result.fetchall())
    actual = rows_of(spark_result.columns, spark_result.collect())
    missing, extra = expected - actual, actual - expected
    return [f"missing {r}" for r in list(missing)[:3]] + [f"extra {r}" for r in list(extra)[:3]]
