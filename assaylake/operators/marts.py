"""Gold marts over Silver rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def risk_by_region(silver: DataFrame) -> DataFrame:
    """Mean risk, rows, and rows above low risk, for each region; riskiest first.

    Sums and counts are combined in each task before the shuffle, so a region holding most rows
    still sends one row per task.
    """
    suspicious = F.count_if(F.col("anomaly") != "low_risk")
    return (
        silver.groupBy("location_region")
        .agg(
            F.round(F.avg("risk_score"), 2).alias("avg_risk_score"),
            F.count(F.lit(1)).alias("total_transactions"),
            suspicious.alias("suspicious_transactions"),
        )
        .orderBy(F.desc("avg_risk_score"), F.asc("location_region"))
    )


def sales_only(silver: DataFrame) -> DataFrame:
    """Sales; on partitioned Silver this reads the one folder."""
    return silver.filter(F.col("transaction_type") == "sale")


def latest_sale_per_address(sales: DataFrame, ties: Sequence[str] | None = None) -> DataFrame:
    """The newest sale of each receiving address, the larger amount first on equal time.

    ``ties`` orders sales that are equal in both, by default all other columns, so a recomputed
    task picks the same row. The ``= 1`` filter lets Spark cut each task's rows to one per address
    before the shuffle, so an address holding a third of all sales does not fill one task.
    """
    if ties is None:
        ties = [c for c in sales.columns if c not in ("receiving_address", "timestamp", "amount")]
    newest = Window.partitionBy("receiving_address").orderBy(
        F.desc("timestamp"), F.desc("amount"), *(F.asc(c) for c in ties)
    )
    return (
        sales.withColumn("recency", F.row_number().over(newest)).filter(F.col("recency") == 1).drop("recency")
    )


def top_receiving_sales(silver: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` largest among the newest sales of all addresses.

    Only three columns leave the scan, and the top-k keeps ``k`` rows per task.
    """
    sales = sales_only(silver).select("receiving_address", "amount", "timestamp")
    return (
        latest_sale_per_address(sales, ties=())
        .orderBy(F.desc("amount"), F.desc("timestamp"), F.asc("receiving_address"))
        .limit(k)
    )
