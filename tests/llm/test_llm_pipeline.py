from __future__ import annotations

import hashlib

import corpus_pipeline as P
import numpy as np
import pytest
from conftest import SF
from helpers_llm import BPE, components, leaked, statistics
from pyspark.sql import functions as F
from test_llm_operators import ODD, odd_docs

from assaylake.llm.oracle import ORACLE
from assaylake.llm.queries import QUERIES
from assaylake.plans.scratch import new_folder


def rows_of(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_each_stage_equals_brute_force(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = rows_of(docs)
    kept = P.quality(spark, docs, SF)
    assert kept.columns == docs.columns
    after = rows_of(kept)
    for i, r in before.items():
        n, _, _, _, repeated = statistics(r["text"])
        if n < 20 or 100 * repeated > 30 * n:
            assert i not in after
        elif i in after:
            assert after[i] == r
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    clean = [i for i in good if i in before and not (lambda s: s[0] < 20 or 100 * s[4] > 30 * s[0])(statistics(before[i]["text"]))]
    assert len([i for i in clean if i in after]) >= 0.95 * len(clean)

    single = rows_of(P.near_duplicate(spark, docs, SF))
    least = components([(i, r["text"]) for i, r in before.items()], 5, 80)
    assert set(single) == {i for i in before if least[i] == i}
    assert all(single[i] == before[i] for i in single)

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = rows_of(P.decontaminate(spark, docs, SF))
    assert clean == {i: r for i, r in before.items() if not leaked(r["text"], items)[1]}

    more = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    whole, hidden = rows_of(more), rows_of(P.redact_secrets(spark, more, SF))
    assert set(hidden) == set(whole)
    changed = {i for i in whole if hidden[i] != whole[i]}
    assert changed and all("[secret]" in hidden[i]["text"] and hidden[i]["n_chars"] == len(hidden[i]["text"]) for i in changed)
    spans = {r["doc_id"]: r["spans"] for r in QUERIES["op5_secrets"](spark, "/root/testdata/sf0.01").collect()}
    assert changed == {i for i, s in spans.items() if s}

    library = Tokenizer.from_file(BPE)
    for i, r in rows_of(P.tokenize(spark, docs, SF)).items():
        ids = library.encode(before[i]["text"], add_special_tokens=False).ids
        assert r["round_trip"] and r["n_tokens"] == len(ids)
        assert bytes(r["ids"]) == b"".join(x.to_bytes(4, "little") for x in ids)


def test_digests_of_ids_equal_the_library(spark):
    from tokenizers import Tokenizer

    library, texts = Tokenizer.from_file(BPE), {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op4_byte_bpe"](spark, SF).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_repeated_rows_with_a_map(spark):
    rows = [(1, "a b c d e f", {"k": 2}), (1, "a b c d e f", {"k": 1}), (2, "x y z", None), (None, "x y z", {"k": 3})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra map<string,int>")
    out = P.near_duplicate(spark, docs, SF)
    assert out.columns == docs.columns and sorted(map(str, out.collect())) == sorted(map(str, [r for i, r in enumerate(docs.collect()) if i]))


def test_queries_without_sql():
    assert set(QUERIES) - set(ORACLE) == {q for q in QUERIES if q.split("_")[0] in ("op1", "op4", "op6", "op7", "op8", "op9")}


ODD_QUERIES = (
    "op1_token_counts", "op2_decontamination", "op3_phrases", "op4_byte_bpe", "op5_secrets", "op6_toxicity", "op7_minhash", "op8_licenses",
    "op9_quality_rules", "op10_suffix_arrays", "op11_collocations",
)


@pytest.mark.parametrize("name", ODD_QUERIES)
def test_queries_on_odd_and_empty_tables(spark, name, tmp_path):
    """NULL ids, repeated ids with different texts, a map column, a long text; then empty tables."""
    texts = [(None, None, None), (None, "a b c " * 20, None), (1, "", "a/b"), (1, "password: hunter22 " * 9, "s"), (1, "other words " * 30, "s"), (2, "\u00e9 word " * 300_000, "s"), (3, None, "")]
    docs = spark.createDataFrame([(i, t, None, s, 3, {"k": 1}) for i, t, s in texts], "doc_id long, text string, lang string, source string, n_chars long, extra map<string,int>")
    columns = None
    for folder, rows in (("odd", docs), ("empty", docs.where("false"))):
        rows.write.parquet(str(tmp_path / folder / "documents.parquet"))
        for other in ("benchmark", "labels"):
            spark.read.parquet(f"{SF}/{other}.parquet").where("true" if folder == "odd" else "false").write.parquet(str(tmp_path / folder / f"{other}.parquet"))
        out = QUERIES[name](spark, str(tmp_path / folder))
        found = out.collect()
        columns = columns or out.columns
        assert out.columns == columns and (name == "op11_collocations" or len(found) == rows.count())


def test_stages_take_odd_rows_and_empty_tables(spark):
    for rows in (odd_docs(spark), odd_docs(spark).where("false")):
        docs, folder = rows, new_folder(spark, "stages")
        for n, (name, stage) in enumerate(P.STAGES):
            out = stage(spark, docs, SF)
            if name != P.STAGES[-1][0]:
                assert out.columns == docs.columns
            out.write.parquet(f"{folder}/{n}")
            docs = spark.read.parquet(f"{folder}/{n}")
    one = P.near_duplicate(spark, odd_docs(spark), SF)
    assert one.where(F.col("doc_id") == 4).count() == 1
    assert one.where("doc_id is null").count() == sum(i is None for i, _ in ODD)


def test_the_whole_pipeline(spark):
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "round_trip"]
    rows = out.collect()
    assert rows and all(r["round_trip"] for r in rows)
