from __future__ import annotations

from helpers_llm import components

from assaylake.llm import near_duplicates
from assaylake.plans.scratch import new_folder


def test_texts_of_one_id_in_two_large_groups(spark):
    """Both texts of id 0 share coordinates with more than four classes each."""
    groups = [[f"{g}{i}" for i in range(120)] for g in "xy"]
    rows = [(0, " ".join(g)) for g in groups]
    for n, g in enumerate(groups):
        for i in range(12):
            rows.append((100 * (n + 1) + i, " ".join(g[:-1] + [f"end{n}{i}"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates.near_duplicates(docs, scratch=new_folder(spark, "t"), percent=80).collect()
    assert len(found) == len(rows) and {r["component_id"] for r in found} == {0}
    assert components(rows[1:], 5, 80)[211] == 0
