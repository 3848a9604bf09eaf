import json
import re
from datetime import timedelta
from decimal import Decimal

import pytest
from conftest import SF, T0, address, executed_plan, transaction
from pyspark.sql import functions as F

from assaylake import schemas as S
from assaylake.quality import engine, report
from assaylake.quality import rules as R
from assaylake.registry import transactions as tx

RULES = {rule.name: rule for rule in (*R.ROW_RULES, *R.CONDITIONAL_RULES)}

# One change to a valid row for each rule it must break.
BREAKS = {
    **{f"not_null:{c}": {c: None} for c in S.RAW_COLUMNS},
    "region_not_blank": {"location_region": " "},
    "in_set:transaction_type": {"transaction_type": "scam"},
    "in_set:purchase_pattern": {"purchase_pattern": "weird"},
    "in_set:age_group": {"age_group": "ancient"},
    "in_set:anomaly": {"anomaly": "unknown"},
    "in_set:location_region": {"location_region": "None"},
    "range:amount": {"amount": Decimal("-0.01")},
    "range:risk_score": {"risk_score": Decimal("100.01")},
    "range:login_frequency": {"login_frequency": -1},
    "range:session_duration": {"session_duration": 0},
    "length42:sending_address": {"sending_address": "0x1"},
    "length42:receiving_address": {"receiving_address": "0x1"},
    "regex:sending_address": {"sending_address": address(1).replace("0x", "0X")},
    "regex:receiving_address": {"receiving_address": address(1)[:-1] + "g"},
    "regex:ip_prefix": {"ip_prefix": "1.2.3.4.5"},
    "cond:transfer_purchase_pattern": {"transaction_type": "transfer", "age_group": "none"},
    "cond:transfer_age_group": {"transaction_type": "transfer", "purchase_pattern": "none"},
    "cond:high_risk": {"anomaly": "high_risk", "risk_score": Decimal("69.99")},
    "cond:moderate_risk": {"anomaly": "moderate_risk", "risk_score": Decimal("70.00")},
    "cond:low_risk": {"risk_score": Decimal("40.00")},
    "cond:region_domain": {"location_region": "Atlantis"},
}

KEEPS = [
    {"ip_prefix": "1.2"},
    {"ip_prefix": "999.2.3.4"},
    {"amount": Decimal("0.00")},
    {"session_duration": 1},
    {"anomaly": "high_risk", "risk_score": Decimal("70.00")},
    {"anomaly": "high_risk", "risk_score": Decimal("100.00")},
    {"anomaly": "moderate_risk", "risk_score": Decimal("40.00")},
    {"risk_score": Decimal("0.00")},
    {"transaction_type": "transfer", "purchase_pattern": "none", "age_group": "none"},
]


def by_rule(results) -> dict:
    return {r["rule"]: r for r in results.collect()}


def all_results(rows) -> dict:
    judged = engine.run_suite(rows)
    return {**by_rule(engine.result_rows(judged)), **by_rule(engine.result_rows(judged, "conditional"))}


def test_the_suite_has_35_checks_and_6_conditional_rules():
    assert len(engine.suite_checks([S.SILVER], S.SILVER.names)) == 35
    assert len(R.CONDITIONAL_RULES) == len(report.CONDITIONAL_NAMES) == 6
    assert set(BREAKS) == set(RULES)


def test_each_rule_is_broken_by_its_row_only(silver):
    rows = [transaction(timestamp=T0 + timedelta(seconds=i), **keep) for i, keep in enumerate(KEEPS)]
    assert all(r["success"] for r in all_results(silver(*rows)).values())
    broken = silver(*rows, *(transaction(**change) for change in BREAKS.values()))
    results = all_results(broken)
    for name, rule in RULES.items():
        assert results[name]["unexpected_count"] == broken.filter(F.expr(rule.breaks)).count() > 0, name
        assert not results[name]["success"]
        tested = len(BREAKS) + len(KEEPS) - (0 if rule.kind == "not_null" else 1)
        assert results[name]["tested"] == tested


def test_counts_agree_between_both_kinds_of_pass(spark):
    rows = tx.raw_typed_stamped(spark, SF)
    with_values = all_results(rows)
    for name, result in by_rule(engine.run_row_rules(rows, list(RULES.values()))).items():
        assert result == with_values[name]


def test_schema_checks(silver):
    rows = silver(transaction())
    assert all(r["success"] for r in by_rule(engine.run_schema_checks(rows)).values())

    def failed(changed):
        return {n for n, r in by_rule(engine.run_schema_checks(changed)).items() if not r["success"]}

    assert failed(rows.drop("ip_prefix")) == {"column_set"}
    assert failed(rows.withColumn("extra", F.lit(1))) == {"column_set"}
    assert failed(rows.withColumn("amount", F.col("amount").cast("string"))) == {"type:amount"}
    assert failed(rows.withColumn("amount", F.col("amount").cast("decimal(9,1)"))) == set()
    assert failed(rows.withColumn("session_duration", F.col("session_duration").cast("long"))) == {
        "type:session_duration"
    }


def test_checks_on_an_absent_column_fail_without_counts(silver):
    judged = engine.judge(
        engine.all_findings(silver(transaction()).drop("ip_prefix", "amount")),
        engine.suite_checks([kept := silver(transaction()).drop("ip_prefix", "amount").schema], kept.names),
    )
    failed = {n: r for n, r in by_rule(engine.result_rows(judged)).items() if not r["success"]}
    assert set(failed) == {
        "column_set",
        "type:amount",
        "not_null:amount",
        "range:amount",
        "not_null:ip_prefix",
        "regex:ip_prefix",
        "unique:transaction",
    }
    assert {r["unexpected_count"] for r in failed.values()} == {0}


def test_unique_key_counts_rows_and_groups(silver):
    rows = silver(transaction(), transaction(session_duration=7), transaction(session_duration=8), transaction(amount=None))
    result = by_rule(engine.run_unique_check(rows))["unique:transaction"]
    assert (result["tested"], result["unexpected_count"]) == (4, 3)
    assert json.loads(report.report(engine.run_suite(rows)).first()[0])["duplicate_count"] == 1


def test_no_rows_pass_every_rule(silver):
    results = all_results(silver(transaction()).filter("amount < 0"))
    assert all(r["success"] and r["tested"] == 0 for r in results.values())


def test_samples_are_the_most_frequent_values(silver):
    regions = ["X"] * 3 + ["Y"] * 2 + [f"Z{i:02}" for i in range(30)]
    rows = silver(*(transaction(location_region=r, timestamp=T0 + timedelta(i)) for i, r in enumerate(regions)))
    samples = {}
    for r in report.rule_samples(engine.run_suite(rows)).collect():
        samples.setdefault(r["rule"], []).append((r["value"], r["n"]))
    expected = [("X", 3), ("Y", 2)] + [(f"Z{i:02}", 1) for i in range(30)]
    assert samples == {"in_set:location_region": expected[:10], "cond:region_domain": expected[:20]}


def test_report(silver):
    rows = silver(
        transaction(location_region="Atlantis"),
        transaction(location_region="Atlantis", session_duration=5),
        transaction(anomaly=None, timestamp=T0 + timedelta(1)),
    )
    line = report.report(engine.run_suite(rows), T0).first()[0]
    found = json.loads(line)
    assert "\n" not in line
    assert list(found) == [
        "execution_timestamp_utc",
        "total_records",
        "validation_success",
        "conditional_rules_success",
        "overall_success",
        "total_expectations",
        "successful_expectations",
        "failed_expectations_count",
        "failed_expectations",
        "conditional_failures",
        "duplicate_count",
        "anomaly_distribution",
        "location_region_distribution",
        "allowed_location_regions",
    ]
    assert found["total_records"] == 3
    assert (found["total_expectations"], found["successful_expectations"]) == (35, 31)
    assert [(f["expectation"], f["column"], f["unexpected_count"]) for f in found["failed_expectations"]] == [
        ("expect_column_values_to_not_be_null", "anomaly", 1),
        ("expect_column_values_to_be_in_set", "location_region", 2),
        ("expect_column_distinct_values_to_be_in_set", "location_region", 0),
        ("expect_compound_columns_to_be_unique", None, 2),
    ]
    assert found["failed_expectations"][1]["partial_unexpected_list"] == ["Atlantis"]
    assert found["conditional_failures"]["location_region_domain_rule"] == {
        "invalid_count": 2,
        "sample_values": ["Atlantis"],
    }
    assert found["conditional_failures"]["low_risk_score_range_rule"] == {"invalid_count": 0}
    none = {"records": 0, "distinct_values": 0}
    levels = {level: 0 for level in S.ANOMALY_LEVELS} | {"low_risk": 2}
    assert found["anomaly_distribution"] == {**levels, "blank": 0, "null": 1, "outside_domain": none}
    regions = {region: 0 for region in S.LOCATION_REGIONS} | {"Asia": 1}
    atlantis = {"records": 2, "distinct_values": 1}
    assert found["location_region_distribution"] == {**regions, "blank": 0, "null": 0, "outside_domain": atlantis}
    assert found["allowed_location_regions"] == list(S.LOCATION_REGIONS)


@pytest.mark.parametrize("n", [3, 10_000])
def test_a_distribution_has_one_shape(spark, silver, n):
    wide = silver(transaction()).crossJoin(spark.range(n)).withColumn("location_region", F.concat(F.lit("R"), F.col("id").cast("string")))
    found = json.loads(report.report(engine.run_suite(wide.drop("id"))).first()[0])
    regions = found["location_region_distribution"]
    assert list(regions) == [*S.LOCATION_REGIONS, "blank", "null", "outside_domain"]
    assert regions["outside_domain"] == {"records": n, "distinct_values": n}
    assert found["anomaly_distribution"]["low_risk"] == n == found["total_records"]


def test_absent_columns_fail_and_do_not_stop(silver):
    for column in ("anomaly", "location_region"):
        found = json.loads(report.report(engine.run_suite(silver(transaction()).drop(column))).first()[0])
        assert found["total_records"] == 1 and not found["overall_success"]


def test_literals_are_escaped(silver):
    rows = silver(transaction(age_group="o'b\\c"), transaction(session_duration=9))
    rule = R.in_set("age_group", ["o'b\\c"])
    assert engine.run_row_rules(rows, [rule]).first()["unexpected_count"] == 1
    assert R.literal("a'b\\") == "'a\\'b\\\\'"


def test_generated_method_stays_compilable(spark, silver):
    """The JVM leaves methods of over 8,000 bytes uncompiled, so the pass over all rows would slow down."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan has no code before it runs
    try:
        plan = engine.all_facts(silver(transaction()))._jdf.queryExecution().executedPlan()
        debug = spark._jvm.org.apache.spark.sql.execution.debug
        text = getattr(debug, "package").codegenString(plan)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_the_suite_reads_the_table_twice(spark, tmp_path):
    folder = str(tmp_path / "typed")
    tx.raw_typed_stamped(spark, SF).write.parquet(folder)
    suite = report.report(engine.run_suite(spark.read.parquet(folder)))
    suite.collect()
    plan = executed_plan(suite)
    assert plan.count("FileScan parquet") == 2
    assert plan.count("ReusedExchange") == 2
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    # Values are cut to the top ones in each task before they are ranked.
    assert plan.count("WindowGroupLimit") == 2
