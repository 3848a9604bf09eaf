from __future__ import annotations

import numpy as np
import pytest

from assaylake.llm import components, embedding_duplicates
from assaylake.plans.scratch import new_folder

SCHEMA = "vec_id long, embedding array<float>, label int, node string, grp int, cls string"


def brute_force(rows, cosine=0.98):
    """(id, links, component, kept) over (id, vector, label)."""
    n, least = len(rows), [r[0] for r in rows]
    width = max((len(v) for _, v, _ in rows if v), default=0)
    unit = np.zeros((n, width))
    for i, (id_, v, y) in enumerate(rows):
        if id_ is not None and y is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            unit[i, : len(v)] = x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max())
    label = [r[2] for r in rows]
    near = [[j for j in range(n) if j != i and label[i] == label[j] and unit[i] @ unit[j] >= cosine] for i in range(n)]
    changed = True
    while changed:
        changed = False
        for i in range(n):
            if near[i] and (m := min(least[j] for j in near[i])) < least[i]:
                least[i], changed = m, True
    return sorted(((r[0], len(near[i]), least[i], r[0] is None or least[i] == r[0]) for i, r in enumerate(rows)), key=str)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    out = embedding_duplicates.near_duplicates(frame, scratch=new_folder(spark, "t"), **options)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, out.collect()), key=str)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 0.5], 1), (2, [2.0, 1.0], 1), (2, [2.0, 1.0], 1), (3, [2.0, 1.0], 2), (4, [2.0, 1.0, 0.0], 1), (6, [1.0], 1), (7, [-1.0, 0.0], 1), (8, [1.0, 0.0], 1)]
    rows += [(9, [], 1), (10, None, 1), (11, [nan, 1.0], 1), (12, [inf, 1.0], 1), (13, [None, 1.0], 1), (14, [0.0, -0.0], 1), (15, [2.0, 1.0], None), (None, [2.0, 1.0], 1)]
    rows += [(16, [3e38, 1.5e38], 1), (17, [2e-40, 1e-40], 1)]
    assert found(spark, rows) == brute_force(rows)
    assert found(spark, rows[8:]) == brute_force(rows[8:]) and found(spark, []) == []


@pytest.mark.parametrize("bounds", [(256, 1024), (8, 16), (2, 5)])
def test_groups_of_near_copies(spark, monkeypatch, bounds):
    """With small bounds, hot buckets join groups as they are, and groups are cut into rings and blocks."""
    monkeypatch.setattr(embedding_duplicates, "BUCKET", bounds[0])
    monkeypatch.setattr(embedding_duplicates, "GROUP", bounds[1])
    random = np.random.default_rng(3)
    rows = []
    for centre, (size, noise) in enumerate([(120, 0.01), (90, 0.03), (60, 0.06), (40, 0.001), (1, 0), (200, 2.0)]):
        c = random.standard_normal(24)
        c /= np.linalg.norm(c)
        for _ in range(size):
            v = c + noise * random.standard_normal(24) * random.choice([0.3, 1])
            rows.append((len(rows) * 7 % 1009, [float(np.float32(x)) for x in v * random.choice([1, 40])], centre % 2))
    rows += [(2000 + i, rows[3][1], rows[3][2]) for i in range(30)]
    assert found(spark, rows) == brute_force(rows)


def test_recall_of_pairs_at_the_threshold(spark):
    """Lone pairs whose cosine is just over the threshold: at least 0.99 of them are found."""
    random = np.random.default_rng(4)
    rows = []
    for i in range(1000):
        a = random.standard_normal(64)
        a /= np.linalg.norm(a)
        b = random.standard_normal(64)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [(2 * i, a.tolist(), 0), (2 * i + 1, (0.9802 * a + (1 - 0.9802**2) ** 0.5 * b).tolist(), 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = embedding_duplicates.near_duplicates(frame, scratch=new_folder(spark, "t"))
    assert out.where("n_links = 1").count() >= 1980


def test_tables_follow_the_number_of_classes():
    for classes in (0, 1, 1000, 10**6, 10**9, 10**12):
        bits, tables = embedding_duplicates.tables_for(classes, 0.98)
        meet = (1 - np.arccos(0.98) / np.pi) ** bits
        assert (1 - meet) ** tables <= embedding_duplicates.MISSED * 1.0001 and bits <= 48


def test_components_of_long_paths_and_hubs(spark, monkeypatch):
    monkeypatch.setattr(components, "MOST_LINKS", 8)
    path = [(i * 37 % 301, (i + 1) * 37 % 301) for i in range(300)]
    hub = [(1000, 1001 + i) for i in range(200)] + [(2000 + i, 2999) for i in range(200)]
    links = spark.createDataFrame(path + hub + [(5000, 5000)], "a long, b long").repartition(16)
    out = dict(map(tuple, components.connected_components(links, new_folder(spark, "t")).collect()))
    assert out == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1201)} | {i: 2000 for i in [*range(2000, 2200), 2999]}
    assert components.connected_components(links.where("false"), new_folder(spark, "t")).count() == 0
