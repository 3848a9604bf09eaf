from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from assaylake.llm import hard_negatives
from assaylake.llm.queries import QUERIES
from assaylake.plans.scratch import new_folder

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector int, length string"


def brute_force(rows, anchors=100, positives=5, negatives=10):
    """(anchor, positive, rank, negative, positive score, negative score) over (id, vector, label)."""
    usable = [(i, [math.floor(256 * float(x)) for x in v], y) for i, v, y in rows if None not in (i, v, y) and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q, y in usable:
        if i % anchors:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j, label) for j, v, label in usable)
        for p, j, _ in [x for x in scored if x[2] == y and x[1] != i][:positives]:
            other = [(-s, n) for s, n, label in scored if label != y and 30 * -p <= 100 * -s <= 90 * -p]
            out += [(i, j, r + 1, n, -p, s) for r, (s, n) in enumerate(other[:negatives])]
    return sorted(out)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    out = hard_negatives.hard_negatives(frame, F.col("vec_id") % 100 == 0, scratch=new_folder(spark, "t"), **options)
    return sorted(map(tuple, out.collect()))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [0.5, 0.25], 2), (2, [0.5, 0.25], 2), (3, [0.5], 3), (4, [], 2), (5, None, 2)]
    rows += [(6, [nan, 1.0], 2), (7, [inf, 1.0], 2), (8, [None, 1.0], 2), (9, [0.9, 0.1], None), (None, [0.7, 0.2], 2), (100, [0.0, 0.0], 1), (200, [-1.0, 0.5, 0.25], 3)]
    rows += [(10 + i, [0.4, 0.3], 2) for i in range(30)]
    assert found(spark, rows) == brute_force(rows)
    assert found(spark, [(0, [3e38, -3e38], 1), *rows[1:]]) == brute_force(rows[1:])  # no 64-bit score
    assert found(spark, rows[1:3]) == [] and found(spark, []) == []


@pytest.mark.parametrize("scale", [1, 3000.0])
def test_lengths_blocks_and_buckets(spark, monkeypatch, scale):
    """Clustered vectors of many lengths, so that lengths and coordinates prune; several blocks of anchors."""
    monkeypatch.setattr(hard_negatives, "BUCKET_ROWS", 64)
    random = np.random.default_rng(5)
    centres = random.standard_normal((8, 12))
    rows = []
    for i in range(600):
        v = (centres[i % 8] + 0.2 * random.standard_normal(12)) * random.choice([0.1, 1, 1, 5]) * scale
        rows.append((i, [float(np.float32(x)) for x in v], int(i % 8 + (i % 3 == 0))))
    assert found(spark, rows, block_bytes=200) == brute_force(rows)


def test_what_is_pruned_could_not_be_found():
    random = np.random.default_rng(6)
    rows = np.floor(256 * random.standard_normal((500, 8)) * random.choice([0.2, 1, 3], (500, 1))).astype(np.int64)
    bucket = hard_negatives._Bucket(np.arange(500), np.zeros(500, np.int64), rows)
    anchors = rows[:40]
    truth = anchors @ rows.T
    for share in (0.1, 0.02, 0.001):
        least = np.sort(truth, axis=1)[:, -max(1, int(share * 500))]
        a, r, s = bucket.found(anchors, least)
        assert {(x, y, z) for x, y, z in zip(a, r, s, strict=True)} == {(x, y, truth[x, y]) for x, y in zip(*np.nonzero(truth >= least[:, None]), strict=True)}


def test_the_query(spark):
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op12_hard_negatives"](spark, SF).collect())) == brute_force(rows)
