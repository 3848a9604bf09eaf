"""Table layouts and value domains."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- Fixed values: column names, layouts and domains of the transaction data ----

RAW_COLUMNS = (
    "timestamp",
    "sending_address",
    "receiving_address",
    "amount",
    "transaction_type",
    "location_region",
    "ip_prefix",
    "login_frequency",
    "session_duration",
    "purchase_pattern",
    "age_group",
    "risk_score",
    "anomaly",
)

TRANSACTION_KEY = ("timestamp", "sending_address", "receiving_address", "amount", "transaction_type")

TRANSACTION_TYPES = ("purchase", "sale", "transfer")
PURCHASE_PATTERNS = ("focused", "high_value", "random", "none")
AGE_GROUPS = ("new", "established", "veteran", "none")
ANOMALY_LEVELS = ("low_risk", "moderate_risk", "high_risk")
LOCATION_REGIONS = (
    "Africa",
    "Antarctica",
    "Asia",
    "Europe",
    "North America",
    "Oceania",
    "South America",
)

AMOUNT = T.DecimalType(18, 2)
RISK_SCORE = T.DecimalType(5, 2)

# Silver as it is read back: the partition column comes last.
SILVER = (
    T.StructType()
    .add("timestamp", T.TimestampType())
    .add("sending_address", T.StringType())
    .add("receiving_address", T.StringType())
    .add("amount", AMOUNT)
    .add("location_region", T.StringType())
    .add("ip_prefix", T.StringType())
    .add("login_frequency", T.IntegerType())
    .add("session_duration", T.IntegerType())
    .add("purchase_pattern", T.StringType())
    .add("age_group", T.StringType())
    .add("risk_score", RISK_SCORE)
    .add("anomaly", T.StringType())
    .add("ingestion_timestamp", T.TimestampType())
    .add("transaction_type", T.StringType())
)

GOLD_TABLES = {
    "fraud_credit": SILVER,
    "location_region_risk_score": (
        T.StructType()
        .add("location_region", T.StringType())
        .add("avg_risk_score", T.DecimalType(6, 2))
        .add("total_transactions", T.LongType())
        .add("suspicious_transactions", T.LongType())
    ),
    "top_receiving_address_sales": (
        T.StructType()
        .add("receiving_address", T.StringType())
        .add("amount", AMOUNT)
        .add("timestamp", T.TimestampType())
    ),
}

# Text columns that are kept in lower case.
CODE_COLUMNS = ("sending_address", "receiving_address", "transaction_type", "purchase_pattern", "age_group", "anomaly")
