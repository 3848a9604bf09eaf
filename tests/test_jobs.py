import json

import pytest
from conftest import SF, T0, executed_plan, raw_row, transaction
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from assaylake import catalog
from assaylake import schemas as S
from assaylake.operators import cleaning
from assaylake.paths import LakePaths
from assaylake.plans import jobs, scratch, sizing
from assaylake.quality import engine, report
from assaylake.registry import transactions as tx
from assaylake.session import object_store_conf
from assaylake.sources import files


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    source = str(root / "source")
    files.write_csv(tx.raw(spark, SF).repartition(4), source)
    paths = LakePaths(str(root / "lake"))
    return paths, jobs.run_lake(spark, source, paths, loaded_at=T0)


def test_run_counts_what_it_wrote(spark, lake):
    paths, run = lake
    assert run.bronze_rows == tx.raw(spark, SF).count() == files.scan_csv(spark, paths.bronze).count()
    assert run.silver_rows == tx.raw_silver(spark, SF).count() == files.scan_silver(spark, paths.silver).count()
    assert run.quality["total_records"] == run.silver_rows


def test_gold_tables(spark, lake):
    paths, run = lake
    for table, schema in S.GOLD_TABLES.items():
        # The types as written, not as declared on reading.
        assert {f.name: f.dataType for f in spark.read.parquet(paths.gold(table)).schema} == {
            f.name: f.dataType for f in schema
        }
    copy = files.scan_table(spark, "fraud_credit", paths.gold("fraud_credit"))
    assert copy.exceptAll(files.scan_silver(spark, paths.silver)).count() == 0
    assert copy.count() == run.silver_rows
    assert spark.read.parquet(paths.gold("top_receiving_address_sales")).count() == 3


def test_report_file_and_tables(spark, lake):
    paths, run = lake
    written = spark.read.text(paths.quality_report).collect()
    assert len(written) == 1
    assert json.loads(written[0][0]) == run.quality
    assert run.quality["overall_success"] is False
    regions = spark.read.parquet(paths.quality_table("location_region")).collect()
    shown = run.quality["location_region_distribution"]
    for row in regions:
        if row["location_region"] in S.LOCATION_REGIONS:
            assert shown[row["location_region"]] == row["records"]
    assert sum(r["records"] for r in regions) == run.silver_rows
    assert _rows_shown(shown) == run.silver_rows


def _rows_shown(distribution: dict) -> int:
    return sum(n for n in distribution.values() if isinstance(n, int)) + distribution["outside_domain"]["records"]


def test_the_quality_job_scans_silver_twice(spark, lake):
    # facts are written in one scan; what is left of the suite counts keys in the other
    paths, _ = lake
    silver, schemas = files.scan_silver_as_stored(spark, paths.silver, cleaning.as_declared)
    folder = scratch.new_folder(spark, "facts") + "/counted"
    facts = engine.all_facts(silver)
    facts.write.parquet(folder)
    facts.collect()
    suite = report.report(engine.run_suite(silver, spark.read.parquet(folder), schemas))
    suite.collect()
    assert executed_plan(facts).count("FileScan parquet") == 1
    plan = executed_plan(suite)
    assert len([line for line in plan.splitlines() if "FileScan parquet" in line and "sending_address" in line]) == 1


def test_drifted_silver_is_reported(spark, silver, tmp_path):
    changes = {
        "extra": (lambda rows: rows.withColumn("channel", F.lit("web")), {("expect_table_columns_to_match_set", None)}),
        "text": (lambda rows: rows.withColumn("amount", F.lit("n/a")), {("expect_column_values_to_be_of_type", "amount"), ("expect_column_values_to_not_be_null", "amount")}),
    }
    for name, (change, expected) in changes.items():
        paths = LakePaths(str(tmp_path / name))
        files.write_silver(change(silver(transaction())), paths.silver)
        found = jobs.check_quality(spark, paths)
        assert {(f["expectation"], f["column"]) for f in found["failed_expectations"]} == expected


def test_ragged_lines_are_kept_whole(spark, tmp_path):
    (tmp_path / "source").mkdir()
    (tmp_path / "source" / "a.csv").write_text('a,b\n1,2\n1,2,3\n4\n5,"x, y"\n')
    paths = LakePaths(str(tmp_path / "lake"))
    assert jobs.land(spark, str(tmp_path / "source"), paths) == jobs.Landed(2, 2)
    assert {tuple(r) for r in files.scan_csv(spark, paths.bronze).collect()} == {("1", "2"), ("5", "x, y")}
    assert {r[0] for r in spark.read.text(paths.bronze_rejects).collect()} == {"1,2,3", "4"}


def test_drift_of_any_file_is_reported(spark, silver, tmp_path):
    """Columns and types that only some files have, also files in the middle of a folder; values are still judged."""
    rows = silver(transaction(), transaction(login_frequency=-1, receiving_address="0x1"))
    drifts = {
        "extra": (lambda r: r.withColumn("channel", F.lit("web")), {("expect_table_columns_to_match_set", None)}),
        "missing": (lambda r: r.drop("age_group"), {("expect_table_columns_to_match_set", None), ("expect_column_values_to_not_be_null", "age_group")}),
        "wider": (lambda r: r.withColumn("login_frequency", F.col("login_frequency").cast("bigint")), {("expect_column_values_to_be_of_type", "login_frequency")}),
        "text": (lambda r: r.withColumn("amount", F.lit("7.5")), {("expect_column_values_to_be_of_type", "amount")}),
    }
    for kind, (name, (change, expected)) in zip(("sale", "transfer", "purchase", "sale"), drifts.items(), strict=True):
        paths = LakePaths(str(tmp_path / name))
        for folder in ("purchase", "sale", "transfer"):
            some = rows.drop("transaction_type").withColumn("sending_address", F.concat(F.lit(folder), "sending_address")).repartition(2)
            files.write_table(some, f"{paths.silver}/transaction_type={folder}")
            if folder == kind:
                change(some.limit(1)).write.mode("append").parquet(f"{paths.silver}/transaction_type={folder}")
        schemas = files.stored_schemas(spark, paths.silver)
        assert len(schemas) == 2 and len(schemas[1][1]) == 1 and f"={kind}/" in schemas[1][1][0]
        report_ = jobs.check_quality(spark, paths)
        found = {(f["expectation"], f["column"]) for f in report_["failed_expectations"]}
        assert expected <= found and ("expect_column_values_to_match_regex", "receiving_address") in found
        drifted = {f for f in found if f[0] in ("expect_table_columns_to_match_set", "expect_column_values_to_be_of_type")}
        assert drifted == {e for e in expected if e[0] != "expect_column_values_to_not_be_null"}
        assert report_["total_records"] == 7


def test_many_batches_of_footers(spark, silver, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "_FOOTERS_AT_ONCE", 2)
    files.write_silver(silver(*(transaction(sending_address=str(i)) for i in range(5))).repartition(5), str(tmp_path / "s"))
    (tmp_path / "s" / "_hidden").mkdir()
    (tmp_path / "s" / "_hidden" / "x.parquet").write_text("no footer")
    ((schema, names),) = files.stored_schemas(spark, str(tmp_path / "s"))
    assert len(names) == len(list((tmp_path / "s").rglob("part-*.parquet"))) > 2 and set(schema.names) == set(S.SILVER.names)


def test_landing_scans_the_source_once(spark, tmp_path):
    (tmp_path / "source").mkdir()
    for n in range(3):
        (tmp_path / "source" / f"{n}.csv").write_text("a,b\n" + f"{n},1\n{n}\n" * 50)
    tracker, group = spark.sparkContext.statusTracker(), "one-scan"
    read = []
    spark.sparkContext.setJobGroup(group, group)
    try:
        assert jobs.land(spark, str(tmp_path / "source"), LakePaths(str(tmp_path / "lake"))) == jobs.Landed(150, 150)
        for job in tracker.getJobIdsForGroup(group):
            read += [tracker.getStageInfo(s).numTasks for s in tracker.getJobInfo(job).stageIds if tracker.getStageInfo(s)]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # one job may read the first line for the names; one reads all files
    assert len([n for n in read if n >= 3]) <= 1 and len(read) <= 2


def test_landing_without_misfits_or_records(spark, tmp_path):
    for name, text, landed in (("all", "a,b\n1,2\n", (1, 0)), ("none", "a,b\n", (0, 0)), ("bad", "a,b\n1\n", (0, 1))):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.csv").write_text(text)
        paths = LakePaths(str(tmp_path / f"lake-{name}"))
        assert jobs.land(spark, str(tmp_path / name), paths) == jobs.Landed(*landed)
        assert spark.read.text(paths.bronze_rejects).count() == landed[1]
        if landed[0] or landed[1]:
            assert files.scan_csv(spark, paths.bronze).columns == ["a", "b"] and files.scan_csv(spark, paths.bronze).count() == landed[0]


def test_values_survive_landing(spark, tmp_path):
    (tmp_path / "source").mkdir()
    (tmp_path / "source" / "x.csv").write_text('a,"b,c"\n" x ","q ""z"" \\ y"\n,""\n"two\nlines",\\\n')
    paths = LakePaths(str(tmp_path / "lake"))
    before = files.scan_csv(spark, str(tmp_path / "source"), multi_line=True)
    jobs.land(spark, str(tmp_path / "source"), paths, multi_line=True)
    after = files.scan_csv(spark, paths.bronze, multi_line=True)
    assert after.columns == before.columns == ["a", "b,c"]
    assert sorted(map(str, after.collect())) == sorted(map(str, before.collect()))


def test_a_job_that_dies_leaves_the_last_layer(spark, raw, tmp_path, monkeypatch):
    paths = LakePaths(str(tmp_path / "lake"))
    files.write_csv(raw(raw_row()), str(tmp_path / "source"))
    jobs.run_lake(spark, str(tmp_path / "source"), paths, loaded_at=T0)
    before = {p: sorted(map(str, spark.read.parquet(p).collect())) for p in (paths.silver, paths.gold("fraud_credit"))}
    clean, risk = cleaning.clean, jobs.marts.risk_by_region

    def broken(frame):
        """Some tasks finish, one fails."""
        more = frame.crossJoin(spark.range(8).repartition(4))
        return more.withColumn("location_region", F.when(F.col("id") == 7, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("location_region"))).drop("id")

    monkeypatch.setattr(jobs.cleaning, "clean", lambda *a: broken(clean(*a)))
    monkeypatch.setattr(jobs.marts, "risk_by_region", lambda *a: broken(risk(*a)))
    for job in (lambda: jobs.build_silver(spark, paths, T0), lambda: jobs.build_gold(spark, paths)):
        with pytest.raises(Exception, match="lost"):
            job()
    for path, rows in before.items():
        assert sorted(map(str, spark.read.parquet(path).collect())) == rows
    assert files.scan_table(spark, "location_region_risk_score", paths.gold("location_region_risk_score")).count() == 1
    assert not [p for layer in ("silver", "gold") for p in (tmp_path / "lake" / layer).iterdir() if p.name.startswith("_")]


def test_a_failed_swap_puts_the_old_folder_back(spark, tmp_path):
    files.write_text(spark.createDataFrame([("old",)], "value string"), str(tmp_path / "t"))
    with pytest.raises(Exception):  # noqa: B017
        files.replace_folders(spark, {str(tmp_path / "nothing"): str(tmp_path / "t")})
    assert spark.read.text(str(tmp_path / "t")).first()[0] == "old"


def test_quality_stops_a_run_only_on_request(spark, lake):
    with pytest.raises(ValueError, match="quality check failed"):
        jobs.check_quality(spark, lake[0], fail_on_error=True)


def test_catalog(spark, lake):
    paths, run = lake
    for _ in range(2):
        catalog.create_schema(spark, "gold")
        catalog.register_gold(spark, paths)
    assert "gold" in {r[0] for r in catalog.list_schemas(spark).collect()}
    assert {r["tableName"] for r in catalog.list_tables(spark).collect()} == set(S.GOLD_TABLES)
    assert catalog.browse(spark, "fraud_credit").count() == 50
    assert spark.sql("SELECT count(*) FROM gold.fraud_credit").first()[0] == run.silver_rows
    total = spark.sql("SELECT sum(total_transactions) FROM gold.location_region_risk_score").first()[0]
    assert total == run.silver_rows


def test_missing_source_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        jobs.land(spark, str(tmp_path / "nowhere"), LakePaths(str(tmp_path)))


def test_no_valid_rows(spark, raw, tmp_path):
    paths = LakePaths(str(tmp_path))
    files.write_csv(raw(raw_row(anomaly="unknown")), str(tmp_path / "source"))
    assert jobs.land(spark, str(tmp_path / "source"), paths) == jobs.Landed(1, 0)
    assert jobs.build_silver(spark, paths) == 0
    with pytest.raises(ValueError, match="empty"):
        jobs.check_quality(spark, paths)


def test_landing_replaces_what_was_there(spark, raw, tmp_path):
    paths = LakePaths(str(tmp_path))
    for amount in ("1", "2"):
        files.write_csv(raw(raw_row(amount=amount)), str(tmp_path / f"source{amount}"))
        jobs.land(spark, str(tmp_path / f"source{amount}"), paths)
    assert [r["amount"] for r in files.scan_csv(spark, paths.bronze).collect()] == ["2"]


def test_shuffle_partitions_follow_the_input(spark):
    assert sizing.partitions_for(0, 8) == 8
    assert sizing.partitions_for(100 * sizing.BYTES_PER_PARTITION + 1, 8) == 101
    assert sizing.partitions_for(10**15, 8) > 10**6
    assert sizing.partitions_for(10**15, 8, most=1000) == 1000
    assert sizing.partitions_for(10**15, 10**7, most=1000) == 10**7
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sizing.shuffle_sized_for(spark, 100 * sizing.BYTES_PER_PARTITION):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "100"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_scratch_without_a_named_folder_lies_below_the_warehouse(spark, monkeypatch):
    monkeypatch.setattr(scratch, "_SETTING", "spark.checkpoint.dir.unset")
    assert scratch.shared_folder(spark) == spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def test_sizing_starts_no_job(spark, tmp_path):
    (tmp_path / "a").write_text("123")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sizing", "sizing")
    assert files.folder_bytes(spark, str(tmp_path)) == 3
    assert not tracker.getJobIdsForGroup("sizing")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_scratch_lies_in_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch.new_folder(spark, "x"), scratch.new_folder(spark, "x")
    assert first.startswith(named) and first != second


def test_paths():
    paths = LakePaths("s3a://lake/")
    assert paths.silver == "s3a://lake/silver/fraud_credit"
    assert paths.gold("t") == "s3a://lake/gold/t"


def test_object_store_settings():
    conf = object_store_conf("http://store:9000", "key", "secret")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.access.key"] == "key"
    assert conf["spark.hadoop.fs.s3a.secret.key"] == "secret"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert conf["spark.hadoop.fs.s3a.aws.credentials.provider"].endswith("SimpleAWSCredentialsProvider")
