from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from assaylake import schemas as S
from assaylake.session import lake_session

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = lake_session(
        "tests",
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def address(n: int) -> str:
    return "0x" + f"{n:040x}"


def transaction(**changes) -> dict:
    """A Silver row that meets every rule."""
    return {
        "timestamp": T0,
        "sending_address": address(1),
        "receiving_address": address(2),
        "amount": Decimal("10.00"),
        "location_region": "Asia",
        "ip_prefix": "10.0",
        "login_frequency": 3,
        "session_duration": 40,
        "purchase_pattern": "focused",
        "age_group": "veteran",
        "risk_score": Decimal("20.00"),
        "anomaly": "low_risk",
        "ingestion_timestamp": T0,
        "transaction_type": "sale",
        **changes,
    }


@pytest.fixture
def silver(spark):
    def make(*rows: dict):
        return spark.createDataFrame([tuple(r[c] for c in S.SILVER.names) for r in rows], S.SILVER)

    return make


def raw_row(**changes) -> dict:
    return {
        "timestamp": "1704067200",
        "sending_address": address(1),
        "receiving_address": address(2),
        "amount": "10.00",
        "transaction_type": "sale",
        "location_region": "Asia",
        "ip_prefix": "10.0",
        "login_frequency": "3",
        "session_duration": "40",
        "purchase_pattern": "focused",
        "age_group": "veteran",
        "risk_score": "20",
        "anomaly": "low_risk",
        **changes,
    }


@pytest.fixture
def raw(spark):
    schema = ", ".join(f"`{c}` string" for c in S.RAW_COLUMNS)

    def make(*rows: dict):
        return spark.createDataFrame([tuple(r[c] for c in S.RAW_COLUMNS) for r in rows], schema)

    return make


def executed_plan(df) -> str:
    """The plan as it ran, without the plan it started from."""
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
