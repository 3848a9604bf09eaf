"""CSV, Parquet and text: scans and sinks of the three layers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake import schemas as S


def _hadoop(spark: SparkSession, path: str):
    """A path and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def replace_folders(spark: SparkSession, paths: dict[str, str]) -> None:
    """Put finished folders in the place of others: ``paths`` are {finished: wanted}.

    The old folder is moved aside, the finished one moved in, and only then is the old one deleted; if the
    move fails, the old one goes back. On file systems with atomic renames readers see the old or the new rows.
    """
    for finished, wanted in paths.items():
        (new, system), (old, _), (aside, _) = (_hadoop(spark, p) for p in (finished, wanted, _beside(wanted, "old")))
        system.mkdirs(old.getParent())
        had = system.exists(old)
        if had and not system.rename(old, aside):
            raise OSError(f"could not move {wanted} aside")
        moved = False
        try:
            moved = system.rename(new, old)
        finally:
            if had and not moved:
                system.rename(aside, old)
        if not moved:
            raise OSError(f"could not move {finished} to {wanted}")
        if had:
            system.delete(aside, True)
        spark.catalog.refreshByPath(wanted)


def _beside(path: str, label: str) -> str:
    """A path in the same folder that no reader lists."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}-{label}-{uuid.uuid4().hex}"


def _replaced(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Write to a new folder and move it to ``path`` when it is complete. A job that fails or dies before
    leaves what was there."""
    staged = _beside(path, "new")
    try:
        write(staged)
        replace_folders(spark, {staged: path})
    finally:
        folder, system = _hadoop(spark, staged)
        system.delete(folder, True)


def scan_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with a header, every column text, columns known by name.

    ``enforceSchema`` is off so that, in a folder of files, one whose header differs raises instead
    of being read by position. ``multi_line`` allows quoted line breaks, at the price that a file
    can no longer be split between tasks.
    """
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .csv(path)
    )


CORRUPT = "_corrupt_line"


def scan_csv_whole(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """As ``scan_csv``, with one more column: the complete text of a record that has more or fewer fields
    than the header or can't be parsed, else NULL."""
    names = scan_csv(spark, path, multi_line).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*names, CORRUPT)])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


# Values keep their outer spaces, which Spark's writer would strip by default.
_KEEP_SPACES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(rows: DataFrame, path: str) -> None:
    """Replace a CSV folder, a header in each file."""
    _replaced(rows.sparkSession, path, lambda folder: rows.write.options(header=True, **_KEEP_SPACES).csv(folder))


def write_landed(rows: DataFrame, path: str, rejects: str, header: Column | None = None) -> None:
    """Replace two folders in one pass over rows of ``scan_csv_whole``: a CSV folder of the records that fit, a
    header in each file, and a text folder of the complete text of those that don't.

    Each row is written as text to the folder of its kind. The first row of each task brings the header along; rows of
    one kind keep headers first.
    """
    names = [c for c in rows.columns if c != CORRUPT]
    line = F.to_csv(F.struct(*(F.col(f"`{c}`") for c in names)), _KEEP_SPACES)
    fits = F.col(CORRUPT).isNull()
    # Spark finds misfits only in columns it reads, so all of them stay in the scan: no length of theirs is below 0
    whole = F.when(F.array_size(F.array(*(F.col(f"`{c}`") for c in names))) >= 0, F.col(CORRUPT))
    row = F.struct(F.when(fits, _FITS).otherwise(_MISFITS).alias("kind"), F.lit(1).alias("part"), F.when(fits, line).otherwise(whole).alias("value"))
    head = F.struct(F.lit(_FITS).alias("kind"), F.lit(0).alias("part"), F.to_csv(F.struct(*(F.lit(c).alias(c) for c in names)), _KEEP_SPACES).alias("value"))
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    lines = rows.select(first.alias("first"), row.alias("row")).select(F.explode(F.when(F.col("first"), F.array(head, "row")).otherwise(F.array("row"))).alias("r"))
    lines = lines.select("r.*").sortWithinPartitions("kind", "part").select("kind", "value")
    spark, staged = rows.sparkSession, _beside(path, "new")
    try:
        lines.write.partitionBy("kind").text(staged)
        made = {}
        for kind, wanted in ((_FITS, path), (_MISFITS, rejects)):
            folder, system = _hadoop(spark, f"{staged}/kind={kind}")
            system.mkdirs(folder)  # also when no row is of the kind
            made[f"{staged}/kind={kind}"] = wanted
        replace_folders(spark, made)
    finally:
        folder, system = _hadoop(spark, staged)
        system.delete(folder, True)


_FITS, _MISFITS = "fits", "misfits"


def scan_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver with its declared schema: partition values keep their type, and an empty folder gives
    an empty table instead of an error."""
    return spark.read.schema(S.SILVER).parquet(path)


_FOOTERS_AT_ONCE = 1000


def stored_schemas(spark: SparkSession, path: str) -> list[tuple[T.StructType, list[str]]]:
    """The different schemas of the Parquet files below a path, each with its files. Partition columns are text.

    The footers of all files are read, and no data: by a pool of threads of the file reader, for a thousand files at a time, of which only
    schemas not seen before are kept. Files of one schema come in the order of their paths; the schema of most files comes first.
    """
    files_of: dict[str, list[str]] = {}
    read = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.readAllFootersInParallel
    for statuses in _batches(_statuses(spark, path), _FOOTERS_AT_ONCE):
        listed = spark._jvm.java.util.ArrayList()
        for status in statuses:
            listed.add(status)
        for footer in read(spark._jsc.hadoopConfiguration(), listed, True):
            meta = footer.getParquetMetadata().getFileMetaData()
            own = meta.getKeyValueMetaData().get("org.apache.spark.sql.parquet.row.metadata")
            files_of.setdefault(f"{meta.getSchema().toString()}{own or ''}", []).append(footer.getFile().toString())
    made: dict[str, tuple[T.StructType, list[str]]] = {}
    for names in files_of.values():
        schema = scan_files(spark, path, sorted(names)[:1]).schema
        held = made.setdefault(schema.json(), (schema, []))
        held[1].extend(names)
    return sorted(((schema, sorted(names)) for schema, names in made.values()), key=lambda x: (-len(x[1]), x[1]))


def scan_files(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Some Parquet files of a table, with the schema of the first; values of its partitions stay text."""
    setting = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        return spark.read.option("basePath", path).parquet(*names)
    finally:
        spark.conf.set(setting, before)


def _statuses(spark: SparkSession, path: str) -> Iterator:
    """Data files below a path."""
    folder, system = _hadoop(spark, path)
    root = system.makeQualified(folder).toUri().getPath()
    found = system.listFiles(folder, True)
    while found.hasNext():
        status = found.next()
        below = status.getPath().toUri().getPath()[len(root) :].strip("/").split("/")
        if not any(part.startswith((".", "_")) for part in below):
            yield status


def _batches(items: Iterator, size: int) -> Iterator[list]:
    held: list = []
    for item in items:
        held.append(item)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def scan_silver_as_stored(spark: SparkSession, path: str, declared: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, list[T.StructType]]:
    """Silver, and the different schemas its files have, which may not be the declared one. Files of each schema are
    read with it and put in shape by ``declared`` before they meet. A folder without files gives an empty table of the
    declared schema."""
    found = stored_schemas(spark, path)
    if not found:
        return scan_silver(spark, path), [S.SILVER]
    if len(found) == 1:
        return declared(scan_files(spark, path, [path])), [found[0][0]]
    parts = [declared(scan_files(spark, path, names)) for _, names in found]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), [schema for schema, _ in found]


def write_silver(rows: DataFrame, path: str) -> None:
    """Replace Silver, one folder for each transaction type.

    Rows are not shuffled by type: with three types, three tasks would write everything. Each task
    writes to up to three files instead.
    """
    _replaced(rows.sparkSession, path, lambda folder: rows.write.partitionBy("transaction_type").parquet(folder))


def scan_table(spark: SparkSession, table: str, path: str) -> DataFrame:
    """A Gold table with its declared schema."""
    return spark.read.schema(S.GOLD_TABLES[table]).parquet(path)


def write_table(rows: DataFrame, path: str) -> None:
    """Replace an unpartitioned Parquet table."""
    _replaced(rows.sparkSession, path, lambda folder: rows.write.parquet(folder))


def write_text(lines: DataFrame, path: str) -> None:
    """Replace a text folder; the one column holds the lines."""
    _replaced(lines.sparkSession, path, lambda folder: lines.write.text(folder))


def write_line(one_row: DataFrame, path: str) -> None:
    """Replace a text folder that holds one row in one file."""
    write_text(one_row.coalesce(1), path)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a path, as the file system has it; no Spark job runs."""
    folder, system = _hadoop(spark, path)
    return system.getContentSummary(folder).getLength()
