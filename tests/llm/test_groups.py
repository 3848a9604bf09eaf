"""Large groups of near copies that are not one component."""

from __future__ import annotations

import random

import pytest
from helpers_llm import components

from assaylake.llm import near_duplicates
from assaylake.plans.scratch import new_folder


def family(seed, members, most, words=120):
    r, base = random.Random(seed), [f"w{seed}x{i}" for i in range(120)]
    for _ in range(members):
        w = list(base)
        for _ in range(r.randint(1, most)):
            w[r.randrange(words)] = f"e{seed}y{r.randrange(60)}"
        yield " ".join(w[: words - r.randint(0, 6)])


ROWS = list(enumerate([*family(1, 80, 14), *family(2, 80, 9), *family(3, 40, 25)]))


@pytest.mark.parametrize(("rare", "block", "words", "percent"), [((4, 8, 32), 1 << 18, 3, 85), ((1, 2, 3), 1000, 2, 70)])
def test_groups_equal_brute_force(spark, monkeypatch, rare, block, words, percent):
    monkeypatch.setattr(near_duplicates, "RARE", rare)
    monkeypatch.setattr(near_duplicates, "BLOCK_SHINGLES", block)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    folder = new_folder(spark, "t")
    found = near_duplicates.near_duplicates(docs, scratch=folder, words=words, percent=percent)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == components(ROWS, words, percent)
    assert spark.read.parquet(f"{folder}/group-links").count() > 0
