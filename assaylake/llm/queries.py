"""The registered queries of this subpackage: thin, one for each operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from assaylake.llm import (
    bpe,
    collocations,
    decontamination,
    embedding_duplicates,
    hard_negatives,
    licenses,
    near_duplicates,
    quality_rules,
    repeated_phrases,
    secrets,
    suffix_arrays,
    token_counts,
    toxicity,
)
from assaylake.llm.oracle import ORACLE  # noqa: F401
from assaylake.plans.scratch import new_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses of every document, its path being source/lang/doc_id. A document made up mostly of notices is the
    licence file of its directory. Rows of one path are one file, and each of them gets its licenses."""
    docs = _table(spark, sf_dir, "documents")
    name = lambda c: F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), "/", "%2F")
    path = F.concat_ws("/", name("source"), name("lang"), name("doc_id"))
    files = docs.select(path.alias("path"), "text")
    found = licenses.scan(files, licenses.notices(spark), scratch=new_folder(spark, "licenses"))
    return docs.select("doc_id", path.alias("path")).join(found, "path").select(
        "doc_id",
        F.array_join("own.license", ",").alias("own_licenses"),
        F.try_element_at("own.score", F.lit(1)).alias("best_score"),
        "licence_file",
        "inherited_from",
        F.array_join("licenses", ",").alias("licenses"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every text, the base rule, and the verdict of a decision list learned from ``labels``."""
    scratch = new_folder(spark, "quality")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    quality_rules.text_statistics(docs).select("doc_id", "statistics").write.parquet(f"{scratch}/statistics")
    measured = spark.read.parquet(f"{scratch}/statistics")
    rules = quality_rules.learn_decision_list(measured, _table(spark, sf_dir, "labels"), scratch=scratch)
    s = F.col("statistics")
    failed, rule = quality_rules.base_failed(s), rules.verdict(s)
    return measured.select(
        "doc_id",
        *(s[c].alias(c) for c in quality_rules.COUNTS),
        failed.alias("base_failed"),
        (~failed & rule.isNull()).alias("kept"),
        rule.alias("rule"),
    )


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and tokens of every document under the pieces of a public vocabulary."""
    import public_tokenizers

    lexicon = token_counts.zipf_lexicon(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.with_token_counts(_table(spark, sf_dir, "documents").select("doc_id", "text"), lexicon, keep_text=False)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie inside benchmark windows, and the items these come from."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    leaks = F.col("leaks")
    return decontamination.with_leaks(docs, _table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        leaks["n_words"].alias("n_words"),
        leaks["n_hit"].alias("n_hit"),
        F.size(leaks["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(leaks["items"], ","), 256).alias("items_sha256"),
        (leaks["n_hit"] > 0).alias("contaminated"),
    )


def op3_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without words of 50-word passages that also start in a document with a smaller id."""
    docs = _table(spark, sf_dir, "documents")
    kept = repeated_phrases.remove_repeated_passages(docs, scratch=new_folder(spark, "phrases"))
    return kept.select("doc_id", F.col("n_units").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of each text and of the text decoded from them."""
    import public_tokenizers

    file = public_tokenizers.path("byte_bpe_50k.json")
    ids = bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), file, keep_text=False)
    decoded = bpe.decode(ids.withColumn("ids_sha256", F.sha2("ids", 256)), file, keep_ids=False)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document, from a new ledger. This method adds no spans of its own to the base ones."""
    ledger = new_folder(spark, "secrets")
    docs = _table(spark, sf_dir, "documents")
    secrets.scan(docs, ledger, path="doc_id")
    found = secrets.findings_by_path(spark, ledger, path_type=docs.schema["doc_id"].dataType.simpleString())
    count = lambda rule: F.size(F.filter("spans", lambda s: s["rule"] == rule)).cast("long").alias(f"n_{rule}")
    text = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["rule"], s["start"], s["stop"])), ",")
    return found.select(
        F.col("path").alias("doc_id"), *map(count, ("assign", "access", "hex")), F.sha2(text, 256).alias("base_sha256"), text.alias("spans")
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents. Labels of ids whose CRC-32 is a multiple of 5 are held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = lambda id_: F.coalesce(F.crc32(id_.cast("string")) % 5 == 0, F.lit(False))
    labels = _table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    model = toxicity.train(docs, labels)
    score = F.col("score")
    return toxicity.with_scores(docs, model, keep_text=False).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (score >= 0.5).cast("int").alias("predicted"),
        toxicity.flagged(score, F.col("lang"), model).alias("flagged_by_language"),
    )


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents: three-word shingles, similarity of 0.85 or more."""
    docs = _table(spark, sf_dir, "documents")
    return near_duplicates.near_duplicates(docs, scratch=new_folder(spark, "minhash"), words=3, percent=85)


def op10_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without bytes of 50-byte strings that also start in a document with a smaller id."""
    docs = _table(spark, sf_dir, "documents")
    kept = suffix_arrays.remove_repeated_strings(docs, scratch=new_folder(spark, "suffixes"))
    n_spans = F.size("spans").cast("long").alias("n_spans")
    return kept.select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed", n_spans, F.sha2("kept", 256).alias("kept_sha256"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language that occur at least 30 times."""
    return collocations.collocations(_table(spark, sf_dir, "documents"), scratch=new_folder(spark, "collocations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for each hundredth vector and its five best positives. Labels of each seventh vector are changed first."""
    id_, label = F.col("vec_id"), F.col("label")
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(id_ % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
    return hard_negatives.hard_negatives(rows, id_ % 100 == 0, scratch=new_folder(spark, "negatives"))


def op13_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of vectors of one label with a cosine of 0.98 or more."""
    return embedding_duplicates.near_duplicates(_table(spark, sf_dir, "embeddings"), scratch=new_folder(spark, "embeddings"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_decontamination": op2_decontamination,
    "op3_phrases": op3_phrases,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_secrets": op5_secrets,
    "op6_toxicity": op6_toxicity,
    "op7_minhash": op7_minhash,
    "op8_licenses": op8_licenses,
    "op9_quality_rules": op9_quality_rules,
    "op10_suffix_arrays": op10_suffix_arrays,
    "op11_collocations": op11_collocations,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_embedding_duplicates": op13_embedding_duplicates,
}
