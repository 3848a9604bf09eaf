"""The four jobs of the lake, and the chain of them."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from assaylake.operators import cleaning, marts
from assaylake.paths import LakePaths
from assaylake.plans.scratch import new_folder
from assaylake.plans.sizing import shuffle_sized_for
from assaylake.quality import engine, report
from assaylake.session import pin_utc
from assaylake.sources import files


def _counted(rows: DataFrame, write) -> int:
    """Write rows and return how many there were, in one run.

    The count is taken in the stage that writes. Spark adds up such a stage's metrics once for each
    partition, also when tasks run again; a stage that feeds a shuffle could count rows twice after
    executors are lost.
    """
    seen = Observation()
    write(rows.observe(seen, F.count(F.lit(1)).alias("rows")))
    if "rows" not in seen.get:
        raise RuntimeError("the stage that wrote has not reported its row count")
    return int(seen.get["rows"])


@dataclass(frozen=True)
class Landed:
    records: int
    rejects: int


def land(spark: SparkSession, source: str, paths: LakePaths, multi_line: bool = False) -> Landed:
    """Copy a CSV source into bronze, replacing what was there. A missing source raises. Records that don't fit the header, which
    CSV columns can't hold, go to ``bronze_rejects`` with their complete text. The source is scanned once: both
    folders are written, and both kinds of records counted, by the same stage."""
    rows, seen = files.scan_csv_whole(spark, source, multi_line), Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(files.CORRUPT).alias("rejects"))
    files.write_landed(counted, paths.bronze, paths.bronze_rejects)
    rejects = int(seen.get["rejects"])
    return Landed(int(seen.get["rows"]) - rejects, rejects)


def build_silver(
    spark: SparkSession, paths: LakePaths, loaded_at: datetime | None = None, multi_line: bool = False
) -> int:
    """Clean bronze into Silver: one scan, one shuffle. Returns the number of valid rows."""
    pin_utc(spark)
    bronze = files.scan_csv(spark, paths.bronze, multi_line)
    with shuffle_sized_for(spark, files.folder_bytes(spark, paths.bronze)):
        return _counted(
            cleaning.clean(bronze, loaded_at), lambda observed: files.write_silver(observed, paths.silver)
        )


def check_quality(
    spark: SparkSession, paths: LakePaths, run_at: datetime | None = None, fail_on_error: bool = False
) -> dict:
    """Check Silver and write the report; returns it as a dict.

    Failed checks are reported and do not stop anything unless ``fail_on_error`` is set. An empty
    Silver raises. The columns and types checked are those of all stored files, by their footers; for the rules on values, columns
    of another type are read as the declared one, and what can't be read so is NULL, as is a column that some files lack. Silver is read twice: once for
    facts, which are written and give totals, samples and the tables of both whole distributions, and once for
    keys.
    """
    pin_utc(spark)
    stored, schemas = files.scan_silver_as_stored(spark, paths.silver, cleaning.as_declared)
    silver = cleaning.normalise_again(stored)
    with shuffle_sized_for(spark, files.folder_bytes(spark, paths.silver)):
        folder = new_folder(spark, "facts") + "/counted"
        files.write_table(engine.all_facts(silver), folder)
        counted = spark.read.parquet(folder)
        if counted.isEmpty():
            raise ValueError("quality check refused: the silver layer is empty")
        files.write_line(report.report(engine.run_suite(silver, counted, schemas), run_at), paths.quality_report)
        for column in engine.DISTRIBUTIONS:
            files.write_table(engine.distribution(counted, column), paths.quality_table(column))
    written = json.loads(spark.read.text(paths.quality_report).first()[0])
    if fail_on_error and not written["overall_success"]:
        raise ValueError(f"quality check failed: see {paths.quality_report}")
    return written


def build_gold(spark: SparkSession, paths: LakePaths) -> None:
    """Write the three Gold tables, each from its own read of Silver with only the columns it needs."""
    pin_utc(spark)
    silver = files.scan_silver(spark, paths.silver)
    with shuffle_sized_for(spark, files.folder_bytes(spark, paths.silver)):
        files.write_table(silver, paths.gold("fraud_credit"))
        files.write_table(marts.risk_by_region(silver), paths.gold("location_region_risk_score"))
        files.write_table(marts.top_receiving_sales(silver), paths.gold("top_receiving_address_sales"))


@dataclass(frozen=True)
class RunSummary:
    bronze_rows: int
    bronze_rejects: int
    silver_rows: int
    quality: dict


def run_lake(
    spark: SparkSession,
    source: str,
    paths: LakePaths,
    *,
    loaded_at: datetime | None = None,
    fail_on_error: bool = False,
    multi_line: bool = False,
) -> RunSummary:
    """Bronze, Silver, quality, Gold, in this order. ``multi_line`` is for sources with quoted line breaks. Each layer is
    written beside the one it replaces, so a run that dies leaves the last complete ones."""
    landed = land(spark, source, paths, multi_line)
    silver_rows = build_silver(spark, paths, loaded_at, multi_line)
    quality = check_quality(spark, paths, fail_on_error=fail_on_error)
    build_gold(spark, paths)
    return RunSummary(landed.records, landed.rejects, silver_rows, quality)
