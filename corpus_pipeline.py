"""A training corpus from raw documents: stages that each call one operator of ``assaylake.llm``.

1. quality rules: documents that fail the base rule or match a learned rule go;
2. MinHash near-duplicates: of each group (five-word shingles, similarity 0.8) the smallest id stays;
3. benchmark decontamination: documents with a word inside a benchmark window go;
4. secret scans: secrets are replaced by a mark, and ``n_chars`` follows;
5. byte-level BPE: each text becomes ids, checked by decoding them.

Each stage takes (session, documents, data folder) and returns documents with the same columns; the last
returns ``doc_id``, ``lang``, ``source``, ``n_tokens``, ``ids`` (little-endian 32-bit numbers) and ``round_trip``
(decoding the ids gives the text).

Defined cases: a document with a NULL or blank text fails the base rule of stage 1. In stage 2, rows of one
id are one document, of which the smallest row stays; rows with a NULL id link with nothing and stay. Stages
3 to 5 judge each row for itself. Columns beyond those of documents are carried to the last stage. Empty
tables of documents, labels or benchmark items pass. ORACLE_SQL is None, as learned rules and BPE have no SQL;
``tests/llm`` holds the stages against brute force.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from assaylake.llm import bpe, decontamination, near_duplicates, quality_rules, secrets
from assaylake.llm.names import unused
from assaylake.plans.scratch import new_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scratch, (mark,) = new_folder(spark, "pipeline-quality"), unused(docs, "_quality")
    quality_rules.text_statistics(docs, into=mark).write.parquet(f"{scratch}/measured")
    measured = spark.read.parquet(f"{scratch}/measured")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rules = quality_rules.learn_decision_list(measured, labels, scratch=scratch, into=mark)
    statistics = F.col(mark)
    return measured.where(~quality_rules.base_failed(statistics) & rules.verdict(statistics).isNull()).select(*map(_name, docs.columns))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scratch = new_folder(spark, "pipeline-minhash")
    found = near_duplicates.near_duplicates(docs, scratch=scratch)
    found.where("kept and doc_id is not null").select("doc_id").distinct().write.parquet(f"{scratch}/kept")
    kept = docs.join(spark.read.parquet(f"{scratch}/kept").hint("shuffle_hash"), "doc_id", "left_semi")
    # rows of one id are one document: the smallest, by the columns that have an order first
    no_order = [f.name for f in docs.schema if re.search("map<|variant", f.dataType.simpleString())]
    order = [_name(c) for c in docs.columns if c not in no_order]
    if no_order:
        order.append(F.to_json(F.struct(*map(_name, no_order))))
    row = F.struct(*map(_name, docs.columns))
    one = kept.groupBy("doc_id").agg(F.min_by(row, F.struct(*order)).alias("_row")).select("_row.*")
    return one.unionByName(docs.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    (mark,) = unused(docs, "_leaks")
    leaks = decontamination.with_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), into=mark)
    return leaks.where(F.col(mark)["n_hit"] == 0).drop(mark)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ledger = new_folder(spark, "pipeline-secrets")
    secrets.scan(docs, ledger, path="doc_id")
    key, spans = unused(docs, "_blob", "_spans")
    found = secrets.findings_by_blob(spark, ledger).select(F.col("blob").alias(key), F.col("spans").alias(spans))
    blob = F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    marked = docs.withColumn(key, blob).join(found, key, "left").withColumn("text", secrets.redacted(F.col("text"), F.col(spans)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        marked = marked.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return marked.select(*map(_name, docs.columns))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    file = public_tokenizers.path("byte_bpe_50k.json")
    source = docs.select("doc_id", "lang", "source", "text", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_original"))
    ids = bpe.encode(source, file, keep_text=False)
    whole = bpe.decode(ids, file)
    return whole.select("doc_id", "lang", "source", "n_tokens", "ids", (F.col("decoded") == F.col("_original")).alias("round_trip"))


def _name(column: str):
    return F.col(f"`{column}`")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("near duplicates", near_duplicate),
    ("decontamination", decontaminate),
    ("secret scans", redact_secrets),
    ("byte-level BPE", tokenize),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = new_folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{scratch}/{number}")
        docs = spark.read.parquet(f"{scratch}/{number}")
    return docs
