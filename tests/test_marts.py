from datetime import timedelta
from decimal import Decimal

from conftest import SF, T0, address, executed_plan, transaction

from assaylake.operators import marts, profile
from assaylake.registry import transactions as tx
from assaylake.sources import files


def test_risk_by_region(silver):
    rows = silver(
        transaction(risk_score=Decimal("10.00")),
        transaction(risk_score=Decimal("10.01"), anomaly="high_risk"),
        transaction(location_region="Europe", risk_score=Decimal("90.00"), anomaly=None),
    )
    found = [tuple(r) for r in marts.risk_by_region(rows).collect()]
    assert found == [("Europe", Decimal("90.00"), 1, 0), ("Asia", Decimal("10.01"), 2, 1)]


def test_region_totals_add_up(spark):
    valid = tx.typed_valid(spark, SF)
    totals = marts.risk_by_region(valid).groupBy().sum("total_transactions").first()[0]
    assert totals == valid.count()


def test_latest_sale_prefers_newer_then_larger_then_a_fixed_order(silver):
    later = T0 + timedelta(hours=1)
    rows = silver(
        transaction(amount=Decimal("99.00")),
        transaction(timestamp=later, amount=Decimal("1.00")),
        transaction(timestamp=later, amount=Decimal("2.00"), session_duration=9),
        transaction(timestamp=later, amount=Decimal("2.00"), session_duration=8),
        transaction(timestamp=later, amount=Decimal("500.00"), transaction_type="transfer"),
    )
    latest = marts.latest_sale_per_address(marts.sales_only(rows)).collect()
    assert [(r["amount"], r["session_duration"]) for r in latest] == [(Decimal("2.00"), 8)]


def test_top_sales_break_ties_by_time_then_address(silver):
    rows = silver(
        transaction(receiving_address=address(5), amount=Decimal("7.00")),
        transaction(receiving_address=address(4), amount=Decimal("7.00")),
        transaction(receiving_address=address(3), amount=Decimal("7.00"), timestamp=T0 + timedelta(1)),
        transaction(receiving_address=address(6), amount=Decimal("7.00")),
        transaction(receiving_address=address(7), amount=Decimal("6.00")),
    )
    top = [r["receiving_address"] for r in marts.top_receiving_sales(rows).collect()]
    assert top == [address(3), address(4), address(5)]


def test_top_sales_read_one_folder_and_three_columns(spark, silver, tmp_path):
    folder = str(tmp_path / "silver")
    files.write_silver(silver(transaction(), transaction(transaction_type="transfer")), folder)
    top = marts.top_receiving_sales(files.scan_silver(spark, folder))
    assert top.count() == 1
    plan = top._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "PartitionFilters: [isnotnull(transaction_type" in plan
    assert "ReadSchema: struct<timestamp:timestamp,receiving_address:string,amount:decimal(18,2)>" in plan
    assert "TakeOrderedAndProject" in plan
    # Rows are cut to one per address before and after the shuffle.
    assert plan.count("WindowGroupLimit (") == 2


def test_hot_address_sends_few_rows_to_the_ranking_task(spark):
    """A third of all sales share an address; each task cuts them to one before the shuffle."""
    sales = spark.range(0, 90_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('a', id % 100) END AS receiving_address",
        "CAST(id % 1000 AS DECIMAL(18,2)) AS amount",
        "timestamp_seconds(id) AS timestamp",
        "'sale' AS transaction_type",
    )
    top = marts.top_receiving_sales(sales, k=1)
    assert [tuple(r)[:2] for r in top.collect()] == [("a99", Decimal("999.00"))]
    plan = executed_plan(top)
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_value_counts_and_repeated_keys(silver):
    rows = silver(transaction(), transaction(session_duration=77), transaction(anomaly=None, amount=None))
    assert {tuple(r) for r in profile.value_counts(rows, "anomaly").collect()} == {("low_risk", 2), (None, 1)}
    assert tuple(profile.count_repeated_keys(rows).first()) == (1, 2)
    assert profile.repeated_keys(rows).first()["copies"] == 2
