"""From raw text to valid, typed rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake import schemas as S
from assaylake.functions import casts, text

_TITLES = ("location_region",)


def _clean(name: str) -> Column:
    if name in S.CODE_COLUMNS:
        return text.code(name)
    if name in _TITLES:
        return text.title(name)
    return text.trimmed(name)


def normalise_raw(raw: DataFrame) -> DataFrame:
    """The 13 raw columns, by name, trimmed and in one case. A missing column raises."""
    return raw.select(*(_clean(name).alias(name) for name in S.RAW_COLUMNS))


def normalise_again(silver: DataFrame) -> DataFrame:
    """Clean the text columns of a typed table in place; changes nothing on a clean one."""
    present = [name for name in (*S.CODE_COLUMNS, "ip_prefix", *_TITLES) if name in silver.columns]
    return silver.withColumns({name: _clean(name) for name in present})


def as_declared(stored: DataFrame) -> DataFrame:
    """Columns of Silver that are stored in another type, read as their declared one; bad values are NULL."""
    drifted = {
        f.name: F.col(f.name).try_cast(f.dataType)
        for f in S.SILVER
        if f.name in stored.columns and stored.schema[f.name].dataType != f.dataType
    }
    return stored.withColumns(drifted) if drifted else stored


def assign_types(normalised: DataFrame) -> DataFrame:
    """Typed columns in place of their text, in one projection."""
    amount, risk = F.col("amount"), F.col("risk_score")
    return normalised.withColumns(
        {
            "timestamp": casts.epoch_seconds(F.col("timestamp")),
            "amount": casts.decimal_number(amount, S.AMOUNT),
            "login_frequency": casts.whole_number(F.col("login_frequency"), T.IntegerType()),
            "session_duration": casts.whole_number(F.col("session_duration"), T.IntegerType()),
            "risk_score": casts.decimal_number(risk, S.RISK_SCORE),
        }
    )


def drop_copies(typed: DataFrame) -> DataFrame:
    """One row for each set of fully equal rows.

    This is the one shuffle of the Silver job. Copies collapse in each task before it, so a row
    copied a billion times sends one row per task, and the key is the whole row, so no other key
    can be hot. Typed rows are shuffled, which are smaller than their text.
    """
    return typed.dropDuplicates()


def stamp_load_time(rows: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    """Add the load time: the query's own start, or a given one. It is the same for all rows, so
    adding it after ``drop_copies`` removes the same copies without shuffling the column."""
    when = F.current_timestamp() if loaded_at is None else F.lit(loaded_at)
    return rows.withColumn("ingestion_timestamp", when)


def validity_rules() -> dict[str, Column]:
    """What a row must meet to enter Silver. A NULL result counts as not met."""
    col = F.col
    return {
        "timestamp": col("timestamp").isNotNull(),
        "sending_address": col("sending_address").isNotNull(),
        "receiving_address": col("receiving_address").isNotNull(),
        "amount": col("amount") >= 0,
        "transaction_type": col("transaction_type").isin(*S.TRANSACTION_TYPES),
        "location_region": col("location_region").isNotNull(),
        "risk_score": col("risk_score").between(0, 100),
        "login_frequency": col("login_frequency") >= 0,
        "session_duration": col("session_duration") > 0,
        "anomaly": col("anomaly").isin(*S.ANOMALY_LEVELS),
    }


def keep_valid(typed: DataFrame) -> DataFrame:
    """Rows that meet every rule. Catalyst moves these filters below ``drop_copies``."""
    for rule in validity_rules().values():
        typed = typed.filter(rule)
    return typed


def rejects(typed: DataFrame) -> DataFrame:
    """The rows ``keep_valid`` leaves out, with the columns that kept them out."""
    unmet = [F.when(~F.coalesce(rule, F.lit(False)), name) for name, rule in validity_rules().items()]
    return typed.withColumn("reject_reason", F.concat_ws(",", *unmet)).filter(F.col("reject_reason") != "")


def parse(raw: DataFrame) -> DataFrame:
    """Normalised, typed rows, each parsed once. Without the one-element ``inline`` filters would be pushed
    below the typing projection, with a copy of its expressions, and valid rows parsed twice."""
    typed = assign_types(normalise_raw(raw))
    return typed.select(F.inline(F.array(F.struct(*typed.columns))))


def type_raw(raw: DataFrame) -> DataFrame:
    """Normalised, typed, distinct rows, still unfiltered."""
    return drop_copies(assign_types(normalise_raw(raw)))


def clean(raw: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    """Raw rows to Silver rows: filtered, then without copies. A copy of a valid row is valid, so the order
    changes no row, and fewer reach the shuffle."""
    return stamp_load_time(drop_copies(keep_valid(parse(raw))), loaded_at)
