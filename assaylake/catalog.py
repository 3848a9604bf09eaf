"""External tables over the Gold layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake import schemas as S
from assaylake.paths import LakePaths
from assaylake.quality.rules import literal


def create_schema(spark: SparkSession, schema: str = "gold", location: str | None = None) -> None:
    at = f" LOCATION {literal(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`{at}")


def register_gold(spark: SparkSession, paths: LakePaths, schema: str = "gold", replace: bool = False) -> None:
    """Declare the three Gold tables where their files are. Does nothing for tables already there, unless
    ``replace`` is set: then they are declared anew, and the files stay as they are."""
    for table, layout in S.GOLD_TABLES.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layout)
        if replace:
            spark.sql(f"DROP TABLE IF EXISTS `{schema}`.`{table}`")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{schema}`.`{table}` ({columns}) "
            f"USING PARQUET LOCATION {literal(paths.gold(table))}"
        )


def list_schemas(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW SCHEMAS")


def list_tables(spark: SparkSession, schema: str = "gold") -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{schema}`")


def browse(spark: SparkSession, table: str, n: int = 50, schema: str = "gold", order_by: Sequence[str] = ()) -> DataFrame:
    """Some rows of a table, of which Spark reads no more files than it needs; with ``order_by`` the first in
    that order, which reads the whole table."""
    rows = spark.table(f"`{schema}`.`{table}`")
    return rows.orderBy(*(F.asc_nulls_first(c) for c in order_by)).limit(n) if order_by else rows.limit(n)
