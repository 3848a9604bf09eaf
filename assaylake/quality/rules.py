"""The rules of the quality suite.

A row rule is a SQL condition that is true where a row breaks it. NULLs are left to the not-null
rules: a condition over a NULL is NULL, which counts as neither.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import types as T

from assaylake import schemas as S


@dataclass(frozen=True)
class RowRule:
    """A rule that looks at one row at a time. ``column`` holds the tested value; ``breaks`` may read another
    column as well, named in ``given``."""

    name: str
    kind: str
    column: str
    breaks: str
    samples: int = 10
    given: str | None = None

    def fits(self, columns: Sequence[str]) -> bool:
        return self.column in columns and (self.given is None or self.given in columns)


@dataclass(frozen=True)
class TypeRule:
    """The column's type must be of one class; its precision is free."""

    name: str
    kind: str
    column: str
    expected: type[T.DataType]


def literal(value: str) -> str:
    """A SQL string literal, whatever the value holds."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_list(values: Sequence[str]) -> str:
    """SQL list of string literals."""
    return "(" + ", ".join(map(literal, values)) + ")"


def not_null(column: str) -> RowRule:
    return RowRule(f"not_null:{column}", "not_null", column, f"`{column}` IS NULL")


def in_set(column: str, domain: Sequence[str]) -> RowRule:
    return RowRule(f"in_set:{column}", "in_set", column, f"`{column}` NOT IN {text_list(domain)}")


def in_range(column: str, low: int, high: int | None = None) -> RowRule:
    """Bounds are inclusive; without ``high`` the range is open above."""
    outside = f"`{column}` < {low}" + ("" if high is None else f" OR `{column}` > {high}")
    return RowRule(f"range:{column}", "range", column, outside)


def has_length(column: str, n: int) -> RowRule:
    return RowRule(f"length{n}:{column}", "length", column, f"length(`{column}`) <> {n}")


def matches(column: str, pattern: str) -> RowRule:
    return RowRule(f"regex:{column}", "regex", column, f"NOT `{column}` RLIKE {literal(pattern)}")


def not_matching(name: str, column: str, pattern: str) -> RowRule:
    return RowRule(name, "not_regex", column, f"`{column}` RLIKE {literal(pattern)}")


def conditional(name: str, column: str, breaks: str, given: str | None = None) -> RowRule:
    return RowRule(f"cond:{name}", "conditional", column, breaks, samples=20, given=given)


# ---- Fixed values: patterns and lengths of the transaction data ----
ADDRESS_LENGTH = 42
ADDRESS = r"^0x[a-f0-9]{40}$"
BLANK = r"^\s*$"
IP_PREFIX = r"^(\d{1,3})(\.\d{1,3}){1,3}$"

ROW_RULES: tuple[RowRule, ...] = (
    *(not_null(column) for column in S.RAW_COLUMNS),
    not_matching("region_not_blank", "location_region", BLANK),
    in_set("transaction_type", S.TRANSACTION_TYPES),
    in_set("purchase_pattern", S.PURCHASE_PATTERNS),
    in_set("age_group", S.AGE_GROUPS),
    in_set("anomaly", S.ANOMALY_LEVELS),
    in_set("location_region", S.LOCATION_REGIONS),
    in_range("amount", 0),
    in_range("risk_score", 0, 100),
    in_range("login_frequency", 0),
    in_range("session_duration", 1),
    has_length("sending_address", ADDRESS_LENGTH),
    has_length("receiving_address", ADDRESS_LENGTH),
    matches("sending_address", ADDRESS),
    matches("receiving_address", ADDRESS),
    matches("ip_prefix", IP_PREFIX),
)

TYPE_RULES: tuple[TypeRule, ...] = tuple(
    TypeRule(f"type:{column}", "type", column, expected)
    for column, expected in (
        ("timestamp", T.TimestampType),
        ("amount", T.DecimalType),
        ("login_frequency", T.IntegerType),
        ("session_duration", T.IntegerType),
    )
)

EXPECTED_COLUMNS = (*S.RAW_COLUMNS, "ingestion_timestamp")
COLUMN_SET = "column_set"
DISTINCT_REGIONS = "distinct_in_set:location_region"
UNIQUE_KEY = "unique:transaction"


CONDITIONAL_RULES: tuple[RowRule, ...] = (
    conditional(
        "transfer_purchase_pattern",
        "purchase_pattern",
        "transaction_type = 'transfer' AND purchase_pattern <> 'none'",
        given="transaction_type",
    ),
    conditional("transfer_age_group", "age_group", "transaction_type = 'transfer' AND age_group <> 'none'", "transaction_type"),
    conditional("high_risk", "risk_score", "anomaly = 'high_risk' AND (risk_score < 70 OR risk_score > 100)", "anomaly"),
    conditional(
        "moderate_risk", "risk_score", "anomaly = 'moderate_risk' AND (risk_score < 40 OR risk_score >= 70)", "anomaly"
    ),
    conditional("low_risk", "risk_score", "anomaly = 'low_risk' AND (risk_score < 0 OR risk_score >= 40)", "anomaly"),
    conditional("region_domain", "location_region", f"location_region NOT IN {text_list(S.LOCATION_REGIONS)}"),
)
