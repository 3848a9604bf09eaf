"""Nested records that arrive as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- Fixed values: layout of the payload and wording of the message ----
PAYLOAD = "number int, people array<struct<craft:string,name:string>>"
MESSAGE = "%s is currently in space flying on the %s! %s"
GREETING = "Hello! :)"


def flatten_people(payloads: DataFrame, column: str = "payload", greeting: str = GREETING) -> DataFrame:
    """One row for each person listed in a JSON payload, with a message; unreadable payloads give none."""
    person = F.col("person")
    return (
        payloads.select(F.from_json(column, PAYLOAD).alias("payload"))
        .select(F.col("payload.number").alias("number"), F.explode("payload.people").alias("person"))
        .select(
            "number",
            person["craft"].alias("craft"),
            person["name"].alias("name"),
            F.format_string(MESSAGE, person["name"], person["craft"], F.lit(greeting)).alias("message"),
        )
    )
