"""Transactions derived from the ``events`` table, typed (TX) and as dirty text (RAW).

The column expressions are valid in Spark SQL and in ANSI SQL alike, so the same text also feeds
the SQL counterparts in ``oracle.py``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake import schemas as S
from assaylake.operators import cleaning
from assaylake.session import pin_utc

# A fixed load time, so that results can be repeated.
LOADED_AT = datetime(2024, 2, 1)

# Events with the number held in ``props`` as text, taken out once.
NUMBERED_EVENTS = "SELECT *, regexp_extract(props, '[0-9]+', 0) AS k FROM events"

TX_COLUMNS = {
    "timestamp": "CAST(ts AS TIMESTAMP)",
    "sending_address": "'0x' || lpad(CAST(user_id AS STRING), 40, '0')",
    "receiving_address": "'0x' || lpad(CAST(event_id % 37 AS STRING), 40, '0')",
    "amount": "CAST(value AS DECIMAL(18,2))",
    "transaction_type": """CASE event_type WHEN 'click' THEN 'sale' WHEN 'view' THEN 'transfer'
        WHEN 'error' THEN 'scam' WHEN 'signup' THEN 'phishing' ELSE event_type END""",
    "location_region": """CASE user_id % 7 WHEN 0 THEN 'Africa' WHEN 1 THEN 'Asia' WHEN 2 THEN 'Europe'
        WHEN 3 THEN 'North America' WHEN 4 THEN 'Oceania' WHEN 5 THEN 'South America' ELSE 'None' END""",
    "ip_prefix": """CASE WHEN event_id % 50 = 0 THEN 'localhost'
        ELSE CAST(user_id % 256 AS STRING) || '.0' END""",
    "login_frequency": "CAST(event_id % 9 AS INT)",
    "session_duration": "CAST(event_id % 181 AS INT)",
    "purchase_pattern": """CASE WHEN event_type = 'view' AND event_id % 11 <> 0 THEN 'none'
        ELSE 'focused' END""",
    "age_group": "CASE WHEN event_type = 'view' THEN 'none' ELSE 'veteran' END",
    "risk_score": "TRY_CAST(k AS DECIMAL(5,2))",
    "anomaly": """CASE WHEN TRY_CAST(k AS INT) >= 70 THEN 'high_risk'
        WHEN TRY_CAST(k AS INT) > 40 THEN 'moderate_risk' ELSE 'low_risk' END""",
}

RAW_TEXT = {
    "timestamp": """CASE WHEN event_id % 97 = 0 THEN 'bad'
        WHEN event_id % 13 = 0 THEN ' ' || CAST(1704067200 + event_id * 60 AS STRING) || '.0 '
        ELSE CAST(1704067200 + event_id * 60 AS STRING) END""",
    "sending_address": """CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 83 = 0 THEN '0xZZ'
        ELSE ' 0X' || lpad(CAST(user_id AS STRING), 40, 'A') END""",
    "receiving_address": """CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 31 = 0 THEN '0x12'
        ELSE '0x' || lpad(CAST(event_id % 37 AS STRING), 40, '0') || ' ' END""",
    "amount": """CASE WHEN event_id % 107 = 0 THEN 'n/a' WHEN event_id % 101 = 0 THEN '-' ELSE '' END ||
        CASE WHEN event_id % 2 = 1 THEN replace(CAST(CAST(value AS DECIMAL(18,2)) AS STRING), '.', ',')
        ELSE CAST(CAST(value AS DECIMAL(18,2)) AS STRING) END""",
    "transaction_type": """CASE WHEN event_id % 109 = 0 THEN NULL ELSE CASE event_type
        WHEN 'click' THEN ' SALE' WHEN 'view' THEN 'Transfer ' WHEN 'error' THEN 'scam'
        WHEN 'signup' THEN 'phishing' ELSE event_type END END""",
    "location_region": """CASE WHEN event_id % 53 = 0 THEN NULL ELSE CASE user_id % 5 WHEN 0 THEN 'AFRICA'
        WHEN 1 THEN ' asia' WHEN 2 THEN 'north america' WHEN 3 THEN '   ' ELSE 'none' END END""",
    "ip_prefix": """CASE WHEN event_id % 71 = 0 THEN NULL WHEN event_id % 50 = 0 THEN 'localhost'
        ELSE CAST(user_id % 256 AS STRING) || '.0' END""",
    "login_frequency": """CASE WHEN event_id % 113 = 0 THEN 'x' WHEN event_id % 61 = 0 THEN '-1'
        ELSE CAST(event_id % 9 AS STRING) END""",
    "session_duration": """CASE WHEN event_id % 127 = 0 THEN ''
        WHEN event_id % 7 = 0 THEN CAST(event_id % 181 AS STRING) || '.9'
        ELSE CAST(event_id % 181 AS STRING) END""",
    "purchase_pattern": """CASE WHEN event_id % 79 = 0 THEN NULL WHEN event_id % 73 = 0 THEN 'weird'
        WHEN event_type = 'view' THEN 'None' ELSE ' Focused' END""",
    "age_group": """CASE WHEN event_id % 43 = 0 THEN NULL WHEN event_id % 41 = 0 THEN 'ancient'
        WHEN event_type = 'view' THEN 'none' ELSE 'VETERAN' END""",
    "risk_score": """CASE WHEN event_id % 67 = 0 THEN '120' WHEN event_id % 47 = 0 THEN '1234,5'
        WHEN event_id % 2 = 0 THEN k || ',125' ELSE k END""",
    "anomaly": """CASE WHEN event_id % 131 = 0 THEN NULL WHEN event_id % 59 = 0 THEN 'unknown'
        WHEN event_id % 139 = 0 THEN 'high_risk' WHEN event_id % 137 = 0 THEN 'moderate_risk'
        WHEN TRY_CAST(k AS INT) >= 70 THEN 'HIGH_RISK'
        WHEN TRY_CAST(k AS INT) > 40 THEN 'moderate_risk ' ELSE 'low_risk' END""",
}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).withColumn("k", F.regexp_extract("props", "[0-9]+", 0))


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX: one typed transaction for each event, without the load time."""
    return _numbered(spark, sf_dir).select(*(F.expr(e).alias(c) for c, e in TX_COLUMNS.items()))


def typed_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.stamp_load_time(typed(spark, sf_dir), LOADED_AT)


def typed_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.keep_valid(typed(spark, sf_dir))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW: every event as 13 dirty strings, some of them twice and some again under another session
    length. The extra rows come from one scan of ``events``.

    Whole rows pass through the explode, so that later filters stay above it, as they would above a
    scan of stored rows, and do not derive the text a second time.
    """
    event_id = F.col("event_id")
    text = _numbered(spark, sf_dir).select("event_id", *(F.expr(e).alias(c) for c, e in RAW_TEXT.items()))
    original = F.struct(*S.RAW_COLUMNS)
    same_key = F.struct(
        *(F.lit("77").alias(c) if c == "session_duration" else F.col(c) for c in S.RAW_COLUMNS)
    )
    versions = F.array(original, F.when(event_id % 20 == 0, original), F.when(event_id % 30 == 0, same_key))
    return text.select(F.explode(versions).alias("row")).filter(F.col("row").isNotNull()).select("row.*")


def raw_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW normalised, typed and distinct, not yet filtered."""
    return cleaning.type_raw(raw(spark, sf_dir))


def raw_typed_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.stamp_load_time(raw_typed(spark, sf_dir), LOADED_AT)


def raw_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW through the whole cleaning, without the load time."""
    return cleaning.keep_valid(raw_typed(spark, sf_dir))


def raw_silver_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.stamp_load_time(raw_silver(spark, sf_dir), LOADED_AT)
