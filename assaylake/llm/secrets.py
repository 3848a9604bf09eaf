"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of every path is a blob, named by the SHA-256 of its text. The ledger is a folder of three
Parquet tables: ``paths`` (path, version, blob, run), ``scans`` (blob, rule, rule version) and ``findings`` (blob,
rule, rule version, start, stop). ``scan`` adds the paths it is given, works out which pairs of blob and rule
version have not been scanned yet, scans only those, each blob once however many paths hold it, and
appends to the ledger; ``findings_by_path`` joins findings back to all paths and versions.

Places of matches come from the pieces between them: a text is split at the rule's pattern, and running
sums of the lengths of pieces and matches are the starts. All of it is DataFrame functions.

Defined cases: a NULL text is an empty one. Repeated rows of a path are one blob, scanned once; each row
keeps its findings. A NULL path is a path like others. Places are code points, the end exclusive. An empty
table adds nothing. Other columns of the input are not read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


@dataclass(frozen=True)
class Rule:
    """A pattern whose ``group`` must have ``least`` characters. A new ``version`` makes every blob unseen."""

    name: str
    version: int
    pattern: str
    group: int
    least: int


# Runs of the last two are maximal and their length is that of the match, so the least length can be part
# of the pattern; for the first one it can't, as a match that is too short still takes up its text.
RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)

_TABLES = {
    "paths": "path {path}, version long, blob binary, run string",
    "scans": "blob binary, rule string, rule_version int",
    "findings": "blob binary, rule string, rule_version int, start long, stop long",
}


def ledger_table(spark: SparkSession, ledger: str, name: str, path_type: str = "string") -> DataFrame:
    """A table of the ledger; a table not yet written is empty."""
    schema = _TABLES[name].format(path=path_type)
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{ledger}/{name}")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{ledger}/{name}")


def _matches(text: Column, rule: Rule) -> Column:
    """For each match: its number, and the lengths of the piece before it, of itself and of its group."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    group = whole if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    parts = F.arrays_zip(
        F.transform(F.slice(F.split(text, rule.pattern, -1), 1, F.greatest(F.size(whole), F.lit(0))), lambda s: F.length(s)).alias("gap"),
        F.transform(whole, lambda s: F.length(s)).alias("whole"),
        F.transform(group, lambda s: F.length(s)).alias("group"),
    )
    rows = F.transform(
        parts,
        lambda m, i: F.struct(
            F.lit(rule.name).alias("rule"), F.lit(rule.version).alias("rule_version"), i.alias("i"), m["gap"].alias("gap"),
            m["whole"].alias("whole"), (m["group"] >= rule.least).alias("good"),
        ),
    )
    return F.when(text.rlike(rule.pattern), rows)


def _unseen(blobs: DataFrame, scans: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, todo): blobs with the rules whose present version has not been run on them."""
    wanted = F.array(*(F.concat_ws(":", F.lit(r.name), F.lit(r.version)) for r in rules))
    done = scans.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "rule", "rule_version")).alias("done"))
    todo = F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))
    return blobs.join(done, "blob", "left").select("blob", "at", todo.alias("todo")).where(F.size("todo") > 0)


def scan(
    versions: DataFrame, ledger: str, *, path: str = "path", version: str | None = None, text: str = "text", rules: tuple[Rule, ...] = RULES
) -> None:
    """Bring the ledger up to date with ``versions``. The ledger may be new."""
    spark = versions.sparkSession
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    number = F.col(version).cast("long") if version else F.lit(0).cast("long")
    rows = versions.select(F.col(path).alias("path"), number.alias("version"), F.unhex(F.sha2(content, 256)).alias("blob"), content.alias("text"))
    kind = rows.schema["path"].dataType.simpleString()
    run = uuid.uuid4().hex
    rows.select("path", "version", "blob", F.lit(run).alias("run")).write.mode("append").parquet(f"{ledger}/paths")
    paths = ledger_table(spark, ledger, "paths", kind).where(F.col("run") == run)
    # one place for each blob, where its text is read
    blobs = paths.groupBy("blob").agg(F.min(F.struct("path", "version")).alias("at"))
    unseen = _unseen(blobs, ledger_table(spark, ledger, "scans"), rules).select("blob", "at.path", "at.version", "todo")
    place = F.xxhash64("path", "version")
    keyed = rows.select(place.alias("place"), "blob", "text")
    texts = keyed.join(unseen.select(place.alias("place"), F.col("blob").alias("b"), "todo").hint("shuffle_hash"), "place").where("blob = b")
    key = lambda r: F.array_contains("todo", f"{r.name}:{r.version}")
    none = _none()
    found = texts.select("blob", "todo", F.concat(*(F.coalesce(F.when(key(r), _matches(F.col("text"), r)), none) for r in rules)).alias("m"))
    matches = found.where(F.size("m") > 0).select("blob", F.explode("m").alias("m")).select("blob", "m.*").distinct()
    before = Window.partitionBy("blob", "rule", "rule_version").orderBy("i")
    through = F.sum(F.col("gap") + F.col("whole")).over(before.rowsBetween(Window.unboundedPreceding, 0))
    placed = matches.withColumn("stop", through).where("good")
    placed.select("blob", "rule", "rule_version", (F.col("stop") - F.col("whole")).alias("start"), "stop").write.mode("append").parquet(
        f"{ledger}/findings"
    )
    each = F.explode("todo").alias("t")
    unseen.select("blob", each).select(
        "blob", F.substring_index("t", ":", 1).alias("rule"), F.substring_index("t", ":", -1).cast("int").alias("rule_version")
    ).write.mode("append").parquet(f"{ledger}/scans")


def _none() -> Column:
    return F.array().cast("array<struct<rule:string,rule_version:int,i:int,gap:int,whole:int,good:boolean>>")


def findings_by_blob(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans) for blobs with findings under the present rule versions; the spans are an array of
    (start, order of the rule, stop, rule), sorted."""
    present = reduce(lambda a, b: a | b, ((F.col("rule") == r.name) & (F.col("rule_version") == r.version) for r in rules))
    order = reduce(lambda e, r: F.when(F.col("rule") == r[1].name, r[0]).otherwise(e), enumerate(rules), F.lit(None).cast("int"))
    return (
        ledger_table(spark, ledger, "findings")
        .where(present)
        .groupBy("blob")
        .agg(F.sort_array(F.collect_set(F.struct("start", order.alias("order"), "stop", "rule"))).alias("spans"))
    )


def findings_by_path(spark: SparkSession, ledger: str, *, path_type: str = "string", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every path and version in the ledger with its spans, perhaps none."""
    empty = F.array().cast("array<struct<start:bigint,order:int,stop:bigint,rule:string>>")
    paths = ledger_table(spark, ledger, "paths", path_type)
    return paths.join(findings_by_blob(spark, ledger, rules), "blob", "left").select(
        "path", "version", "blob", F.coalesce("spans", empty).alias("spans")
    )


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with each run of overlapping spans replaced by a mark. ``spans`` is sorted, or NULL."""
    zero = F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("at"))

    def step(so_far: Column, s: Column) -> Column:
        gap = F.substring(text, so_far["at"].cast("int") + 1, (s["start"] - so_far["at"]).cast("int"))
        fresh = F.concat(so_far["done"], gap, F.lit(mark))
        return F.struct(
            F.when((s["start"] >= so_far["at"]), fresh).otherwise(so_far["done"]).alias("done"), F.greatest(s["stop"], so_far["at"]).alias("at")
        )

    end = lambda so_far: F.concat(so_far["done"], F.substring(text, so_far["at"].cast("int") + 1, F.length(text)))
    return F.when(spans.isNull(), text).otherwise(F.aggregate(spans, zero, step, end))
