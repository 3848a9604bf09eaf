"""Counts that describe a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake import schemas as S


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    """How many records hold each value."""
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("records"))


def key_counts(rows: DataFrame, key: Sequence[str] = S.TRANSACTION_KEY) -> DataFrame:
    """Keys with their row counts. Copies combine before the shuffle."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))


def repeated_keys(rows: DataFrame, key: Sequence[str] = S.TRANSACTION_KEY) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    return key_counts(rows, key).filter(F.col("copies") > 1)


def count_repeated_keys(rows: DataFrame, key: Sequence[str] = S.TRANSACTION_KEY) -> DataFrame:
    """One row: the number of repeated keys, and of the rows in them."""
    return repeated_keys(rows, key).agg(
        F.count(F.lit(1)).alias("duplicate_count"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("duplicate_rows"),
    )
