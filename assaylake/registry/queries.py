"""One registered query for each operator: (session, data folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake import catalog
from assaylake import schemas as S
from assaylake.functions import casts
from assaylake.operators import cleaning, marts, profile
from assaylake.paths import LakePaths
from assaylake.plans import jobs
from assaylake.plans.scratch import new_folder
from assaylake.quality import engine, report
from assaylake.quality import rules as R
from assaylake.registry import transactions as tx
from assaylake.sources import files, records

Query = Callable[[SparkSession, str], DataFrame]


def _rules(*kinds: str) -> tuple[R.RowRule, ...]:
    return tuple(rule for rule in R.ROW_RULES if rule.kind in kinds)


# ---- Bronze and Silver ----


def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the raw rows as CSV and scan them back. An empty field comes back as NULL."""
    folder = new_folder(spark, "raw_scan")
    files.write_csv(tx.raw(spark, sf_dir), folder)
    return files.scan_csv(spark, folder).select(*S.RAW_COLUMNS)


def silver_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.normalise_raw(tx.raw(spark, sf_dir))


def silver_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.assign_types(cleaning.normalise_raw(tx.raw(spark, sf_dir)))


def silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.rejects(tx.raw_typed(spark, sf_dir))


def parse_decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount, risk = F.trim("amount"), F.trim("risk_score")
    return tx.raw(spark, sf_dir).select(
        amount.alias("amount_text"),
        casts.decimal_number(amount, S.AMOUNT).alias("amount"),
        risk.alias("risk_text"),
        casts.decimal_number(risk, S.RISK_SCORE).alias("risk_score"),
    )


def parse_int_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    login, session = F.trim("login_frequency"), F.trim("session_duration")
    return tx.raw(spark, sf_dir).select(
        login.alias("login_text"),
        casts.whole_number(login, T.IntegerType()).alias("login_frequency"),
        session.alias("session_text"),
        casts.whole_number(session, T.IntegerType()).alias("session_duration"),
    )


def parse_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.trim("timestamp")
    return tx.raw(spark, sf_dir).select(
        text.alias("epoch_text"),
        casts.whole_number(text, T.LongType()).alias("epoch_seconds"),
        casts.epoch_seconds(text).alias("timestamp"),
    )


def _written_silver(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    folder = new_folder(spark, label)
    files.write_silver(rows, folder)
    return files.scan_silver(spark, folder)


def silver_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = cleaning.stamp_load_time(tx.typed_valid(spark, sf_dir), tx.LOADED_AT)
    return _written_silver(spark, stamped, "silver_scan").select(*S.RAW_COLUMNS)


def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written_silver(spark, tx.raw_silver_stamped(spark, sf_dir), "silver_roundtrip").select(*S.RAW_COLUMNS)


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    def rows_of(layer: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.count(F.lit(1)).alias("records")).select(F.lit(layer).alias("layer"), "records")

    raw, silver = tx.raw(spark, sf_dir), tx.raw_silver(spark, sf_dir)
    return rows_of("bronze", raw).unionByName(rows_of("silver", silver))


# ---- Gold ----


def _gold(spark: SparkSession, sf_dir: str, label: str) -> LakePaths:
    """A lake whose Silver holds the valid typed transactions, with its Gold tables built."""
    paths = LakePaths(new_folder(spark, label))
    stamped = cleaning.stamp_load_time(tx.typed_valid(spark, sf_dir), tx.LOADED_AT)
    files.write_silver(stamped, paths.silver)
    jobs.build_gold(spark, paths)
    return paths


def gold_fraud_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = LakePaths(new_folder(spark, "gold_copy"))
    silver = _written_silver(spark, tx.raw_silver_stamped(spark, sf_dir), "gold_source")
    files.write_table(silver, paths.gold("fraud_credit"))
    return files.scan_table(spark, "fraud_credit", paths.gold("fraud_credit")).select(*S.RAW_COLUMNS)


# The one schema that the catalog queries use; each declares its tables anew.
CATALOG_SCHEMA = "assaylake_gold"


def _registered(spark: SparkSession, sf_dir: str, label: str) -> str:
    catalog.create_schema(spark, CATALOG_SCHEMA)
    catalog.register_gold(spark, _gold(spark, sf_dir, label), CATALOG_SCHEMA, replace=True)
    return CATALOG_SCHEMA


def show_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of the schema, as SHOW TABLES lists them."""
    schema = _registered(spark, sf_dir, "show")
    return catalog.list_tables(spark, schema).filter("NOT isTemporary").select(F.col("tableName").alias("table_name"))


def gold_region_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk by region as written, by SQL over the table's name."""
    schema = _registered(spark, sf_dir, "region_values")
    return spark.sql(f"SELECT * FROM `{schema}`.`location_region_risk_score`")


def gold_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top sales as written, by SQL over the table's name."""
    schema = _registered(spark, sf_dir, "top_values")
    return spark.sql(f"SELECT * FROM `{schema}`.`top_receiving_address_sales`")


def load_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, distinct load times and missing ones of a Silver that is stamped by the query itself."""
    silver = cleaning.clean(tx.raw(spark, sf_dir))
    return silver.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("ingestion_timestamp").alias("load_times"),
        F.count_if(F.col("ingestion_timestamp").isNull()).alias("missing"),
    )


def landing_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of a ragged source with quoted line breaks, landed or rejected: (layer, value, records)."""
    paths = LakePaths(new_folder(spark, "landing"))
    text = """CASE WHEN event_id % 10 = 0 THEN concat(event_id, ',x,y,z') WHEN event_id % 10 = 1 THEN concat(event_id, ',x')
        WHEN event_id % 10 = 2 THEN concat(event_id, ',x,"y', chr(10), 'z"') ELSE concat(event_id, ',x,y') END"""
    lines = tx.events(spark, sf_dir).select(F.expr(text).alias("value"))
    # each partition is a file of its own, which begins with the header
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    whole = lines.select(F.when(first, F.concat(F.lit("a,b,c\n"), "value")).otherwise(F.col("value")).alias("value"))
    files.write_text(whole, paths.root + "/source")
    jobs.land(spark, paths.root + "/source", paths, multi_line=True)
    landed = files.scan_csv(spark, paths.bronze, multi_line=True).groupBy("c").agg(F.count(F.lit(1)).alias("records"))
    rejected = spark.read.text(paths.bronze_rejects)
    return landed.select(F.lit("bronze").alias("layer"), F.col("c").alias("value"), "records").union(
        rejected.select(F.lit("rejects"), "value", F.lit(1).cast("bigint"))
    )


def catalog_gold_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each registered table, by SQL over its name."""
    schema = _registered(spark, sf_dir, "catalog")
    selects = (
        f"SELECT '{table}' AS table_name, count(*) AS records FROM `{schema}`.`{table}`" for table in S.GOLD_TABLES
    )
    return spark.sql(" UNION ALL ".join(selects))


def browse_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _registered(spark, sf_dir, "browse")
    columns = spark.table(f"`{schema}`.`fraud_credit`").columns
    return catalog.browse(spark, "fraud_credit", schema=schema, order_by=columns).select(*S.RAW_COLUMNS)


def lake_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four jobs in order, from landed CSV to Gold; the size of every layer they wrote."""
    paths = LakePaths(new_folder(spark, "lake_run"))
    source = paths.root + "/source"
    files.write_csv(tx.raw(spark, sf_dir), source)
    run = jobs.run_lake(spark, source, paths, loaded_at=tx.LOADED_AT)
    gold = None
    for table in S.GOLD_TABLES:
        rows = files.scan_table(spark, table, paths.gold(table))
        counted = rows.agg(F.count(F.lit(1)).alias("records")).select(F.lit(table).alias("layer"), "records")
        gold = counted if gold is None else gold.unionByName(counted)
    counts = [
        ("bronze", run.bronze_rows),
        ("silver", run.silver_rows),
        ("quality_failed_expectations", run.quality["failed_expectations_count"]),
        ("quality_duplicate_keys", run.quality["duplicate_count"]),
    ]
    return gold.unionByName(spark.createDataFrame(counts, "layer string, records bigint"))


# ---- Quality ----


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows before Silver's filters, so that every rule can fail."""
    return tx.raw_typed_stamped(spark, sf_dir)


def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engine.result_rows(engine.run_suite(_typed(spark, sf_dir)))


def dq_suite_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engine.result_rows(engine.run_suite(tx.raw_silver_stamped(spark, sf_dir)))


def dq_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = report.failed_checks(engine.run_suite(tx.raw_silver_stamped(spark, sf_dir)))
    values = F.transform("partial_unexpected_list", lambda value: F.coalesce(value, F.lit("NULL")))
    return failed.withColumn("partial_unexpected_list", F.array_join(values, ";"))


def dq_rule_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.rule_samples(engine.run_suite(_typed(spark, sf_dir)))


def dq_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.verdict(engine.run_suite(tx.raw_silver_stamped(spark, sf_dir)))


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report(engine.run_suite(tx.raw_silver_stamped(spark, sf_dir)), tx.LOADED_AT)


_FAILURE = (
    "array<struct<expectation:string,column:string,unexpected_count:bigint,unexpected_percent:double,"
    "partial_unexpected_list:array<string>>>"
)


def report_leaves(written: DataFrame) -> DataFrame:
    """(path, value) of every leaf of a report's JSON text. A failed check is known by its name and column."""
    json_at = lambda path: F.get_json_object("metrics_json", _json_path(path))
    plain = [
        "execution_timestamp_utc",
        "total_records",
        "validation_success",
        "conditional_rules_success",
        "overall_success",
        "total_expectations",
        "successful_expectations",
        "failed_expectations_count",
        "duplicate_count",
        *(f"conditional_failures.{name}.invalid_count" for name in report.CONDITIONAL_NAMES.values()),
    ]
    for column, (_, domain) in engine.DISTRIBUTIONS.items():
        shown = (*domain, "blank", "null", "outside_domain.records", "outside_domain.distinct_values")
        plain += [f"{column}_distribution.{value}" for value in shown]
    lists = ["allowed_location_regions"]
    lists += [f"conditional_failures.{report.CONDITIONAL_NAMES[r]}.sample_values" for r in report.SAMPLED_CONDITIONALS]
    leaf = lambda path, value: F.struct(path.alias("path"), value.cast("string").alias("value"))
    items = lambda path, values: F.transform(
        values, lambda v, i: leaf(F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), F.coalesce(v, F.lit("NULL")))
    )

    def failure(f):
        path = F.concat_ws(".", F.lit("failed_expectations"), f["expectation"], f["column"])
        share = F.round(f["unexpected_percent"], 6).cast("decimal(20,6)")
        numbers = F.array(leaf(F.concat(path, F.lit(".unexpected_count")), f["unexpected_count"]), leaf(F.concat(path, F.lit(".unexpected_percent")), share))
        return F.concat(numbers, items(path, f["partial_unexpected_list"]))

    failed = F.transform(F.from_json(json_at("failed_expectations"), _FAILURE), failure)
    return written.select(
        F.inline(
            F.concat(
                F.array(*(leaf(F.lit(path), json_at(path)) for path in plain)),
                *(items(F.lit(path), F.from_json(json_at(path), "array<string>")) for path in lists),
                F.flatten(failed),
            )
        )
    )


def dq_report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leaf of the report as written to and read from its text file."""
    folder = new_folder(spark, "report")
    files.write_line(_report(spark, sf_dir), folder)
    return report_leaves(spark.read.text(folder).withColumnRenamed("value", "metrics_json"))


def _drifted(spark: SparkSession, sf_dir: str, label: str, change, write=files.write_silver) -> DataFrame:
    """The schema checks of a quality job's report over a stored Silver with other columns or types: each
    check with its outcome, told from the report's list of failures."""
    paths = LakePaths(new_folder(spark, label))
    write(change(tx.raw_silver_stamped(spark, sf_dir)), paths.silver)
    jobs.check_quality(spark, paths, tx.LOADED_AT)
    failed = F.from_json(F.get_json_object("value", "$.failed_expectations"), _FAILURE)
    rows = spark.read.text(paths.quality_report).select(F.inline(failed))
    # no value broke these, so the columns or types did; distinct regions are counted apart
    broken = (F.col("unexpected_count") == 0) & (F.col("expectation") != report.EXPECTATIONS["distinct_in_set"])
    return rows.filter(broken).select("expectation", "column")


def dq_schema_drift_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drifted(spark, sf_dir, "drift_extra", lambda rows: rows.withColumn("channel", F.lit("web")))


def dq_schema_drift_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drifted(spark, sf_dir, "drift_missing", lambda rows: rows.drop("age_group"))


def dq_schema_drift_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drifted(
        spark,
        sf_dir,
        "drift_type",
        lambda rows: rows.withColumns({"amount": F.col("amount").cast("string"), "login_frequency": F.col("login_frequency").cast("bigint")}),
    )


_FOLDER_DRIFTS = {
    "purchase": lambda rows: rows,
    "sale": lambda rows: rows.withColumn("channel", F.lit("web")),
    "transfer": lambda rows: rows.withColumn("session_duration", F.col("session_duration").cast("bigint")),
}


def _write_mixed(rows: DataFrame, path: str) -> None:
    """Silver whose folders have columns and types of their own."""
    for kind, change in _FOLDER_DRIFTS.items():
        some = rows.filter(F.col("transaction_type") == kind).drop("transaction_type")
        files.write_table(change(some), f"{path}/transaction_type={kind}")


def dq_schema_drift_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder has an extra column and another a wider type; the files of the first one are as declared."""
    return _drifted(spark, sf_dir, "drift_mixed", lambda rows: rows, _write_mixed)


def dq_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows whose text was put in capitals and padded, cleaned again."""
    noisy = {c: F.concat(F.lit(" "), F.upper(c), F.lit(" ")) for c in (*S.CODE_COLUMNS, "location_region")}
    noisy["ip_prefix"] = F.concat(F.lit("  "), F.col("ip_prefix"))
    return cleaning.normalise_again(tx.typed(spark, sf_dir).withColumns(noisy))


def dq_report_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's figures, read back from its JSON: (field, value)."""
    paths = [
        "execution_timestamp_utc",
        "total_records",
        "validation_success",
        "conditional_rules_success",
        "overall_success",
        "total_expectations",
        "successful_expectations",
        "failed_expectations_count",
        "duplicate_count",
        *(f"conditional_failures.{name}.invalid_count" for name in report.CONDITIONAL_NAMES.values()),
        *(f"anomaly_distribution.{level}" for level in S.ANOMALY_LEVELS),
        *(f"location_region_distribution.{region}" for region in ("Africa", "Asia", "North America")),
        "location_region_distribution.outside_domain.records",
    ]
    text = _report(spark, sf_dir)
    entries = (
        F.struct(F.lit(path).alias("field"), F.get_json_object("metrics_json", _json_path(path)).alias("value"))
        for path in paths
    )
    return text.select(F.inline(F.array(*entries)))


def _json_path(path: str) -> str:
    return "$" + "".join(f"['{part}']" for part in path.split("."))


def flatten_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = """'{"number":' || CAST(event_id AS STRING) || ',"people":[{"craft":"' || event_type
        || '","name":"user ' || CAST(user_id AS STRING) || '"},{"craft":"k","name":"'
        || regexp_extract(props, '[0-9]+', 0) || '"}]}'"""
    return records.flatten_people(tx.events(spark, sf_dir).select(F.expr(payload).alias("payload")))


QUERIES: dict[str, Query] = {
    "raw_scan": raw_scan,
    "silver_normalise": silver_normalise,
    "parse_decimal_comma": parse_decimal_comma,
    "parse_int_lenient": parse_int_lenient,
    "parse_epoch": parse_epoch,
    "silver_typed": silver_typed,
    "silver_dedup": tx.raw_typed,
    "silver_valid": tx.raw_silver,
    "silver_rejects": silver_rejects,
    "silver_scan": silver_scan,
    "silver_roundtrip": silver_roundtrip,
    "layer_counts": layer_counts,
    "region_risk": lambda spark, d: marts.risk_by_region(tx.typed_valid(spark, d)),
    "region_risk_raw": lambda spark, d: marts.risk_by_region(tx.raw_silver(spark, d)),
    "sales_only": lambda spark, d: marts.sales_only(tx.raw_silver(spark, d)),
    "latest_sale_per_address": lambda spark, d: marts.latest_sale_per_address(
        marts.sales_only(tx.raw_silver(spark, d))
    ),
    "top_receiving_sales": lambda spark, d: marts.top_receiving_sales(tx.typed_valid(spark, d)),
    "top_receiving_sales_raw": lambda spark, d: marts.top_receiving_sales(tx.raw_silver(spark, d)),
    "gold_fraud_credit": gold_fraud_credit,
    "catalog_gold_tables": catalog_gold_tables,
    "browse_gold": browse_gold,
    "lake_run_summary": lake_run_summary,
    "dist_anomaly": lambda spark, d: profile.value_counts(tx.typed(spark, d), "anomaly"),
    "dist_region": lambda spark, d: profile.value_counts(tx.raw_typed(spark, d), "location_region"),
    "duplicate_keys": lambda spark, d: profile.count_repeated_keys(tx.raw_typed(spark, d)),
    "show_gold": show_gold,
    "gold_region_values": gold_region_values,
    "gold_top_values": gold_top_values,
    "load_time": load_time,
    "landing_accounts": landing_accounts,
    "dq_schema_drift_extra": dq_schema_drift_extra,
    "dq_schema_drift_missing": dq_schema_drift_missing,
    "dq_schema_drift_type": dq_schema_drift_type,
    "dq_schema_drift_mixed": dq_schema_drift_mixed,
    "dq_normalise": dq_normalise,
    "dq_schema_checks": lambda spark, d: engine.run_schema_checks(tx.typed(spark, d)),
    "dq_not_null": lambda spark, d: engine.run_row_rules(_typed(spark, d), _rules("not_null")),
    "dq_in_set": lambda spark, d: engine.run_row_rules(_typed(spark, d), _rules("in_set")),
    "dq_range": lambda spark, d: engine.run_row_rules(_typed(spark, d), _rules("range")),
    "dq_length": lambda spark, d: engine.run_row_rules(_typed(spark, d), _rules("length")),
    "dq_regex": lambda spark, d: engine.run_row_rules(_typed(spark, d), _rules("regex", "not_regex")),
    "dq_distinct_in_set": lambda spark, d: engine.run_distinct_check(_typed(spark, d)),
    "dq_compound_unique": lambda spark, d: engine.run_unique_check(_typed(spark, d)),
    "dq_conditional_rules": lambda spark, d: engine.run_row_rules(_typed(spark, d), R.CONDITIONAL_RULES),
    "dq_suite": dq_suite,
    "dq_suite_silver": dq_suite_silver,
    "dq_failed": dq_failed,
    "dq_rule_samples": dq_rule_samples,
    "dq_verdict": dq_verdict,
    "dq_report_json": dq_report_json,
    "dq_report_fields": dq_report_fields,
    "flatten_records": flatten_records,
}
