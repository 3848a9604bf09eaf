"""Connected components of links, by alternating large-star and small-star steps.

Before each step every partition reduces its links to stars (each node with the smallest node it reaches there), so a
group of copies, however many links it came with, goes on with about one link for each node and partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MOST_LINKS = 1 << 19  # links that a task holds before it reduces them


def smallest_reachable(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` nodes, the smallest node reachable over links a-b."""
    least = np.arange(n)
    while len(a):
        x, y = least[a], least[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
        while True:
            jump = least[least]
            if np.array_equal(jump, least):
                break
            least = jump
    return least


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same groups as links u-v make, as links of each node with the smallest of its group."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    least = smallest_reachable(at[: len(u)], at[len(u) :], len(nodes))
    more = least != np.arange(len(nodes))
    return nodes[more], nodes[least[more]]


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        u, v = (np.concatenate([x, batch.column(c).to_numpy()]) for x, c in ((u, "u"), (v, "v")))
        if len(u) >= MOST_LINKS:
            u, v = stars(u, v)
            if len(u) >= MOST_LINKS // 2:
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
                u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
    u, v = stars(u, v)
    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def connected_components(links: DataFrame, scratch: str, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of a link between different nodes, the component being its smallest node. Nodes are
    whole numbers.

    The number of rounds grows with the logarithm of the longest path. Each round is written to ``scratch``,
    which cuts the lineage and survives lost executors.
    """
    spark = links.sparkSession
    pair = "u long, v long"
    edges = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v").mapInArrow(_reduced, pair)
    edges.write.parquet(f"{scratch}/links")
    edges, step = spark.read.parquet(f"{scratch}/links"), 0
    while True:
        # as many tasks as hold a bounded number of links each; one task alone makes stars of all it has
        tasks = max(1, -(-edges.count() // MOST_LINKS))
        edges = edges.coalesce(tasks).mapInArrow(_reduced, pair)
        (edges if tasks == 1 else edges.distinct()).write.parquet(f"{scratch}/star-{step}")
        edges = spark.read.parquet(f"{scratch}/star-{step}")
        if tasks == 1 or _are_stars(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
        # large star: every larger neighbour is linked with the smallest neighbour
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        edges = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = edges.where("u <> v").distinct()
        # small star: smaller neighbours and the node itself are linked with the smallest
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        edges = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
        edges.where("u <> v").write.parquet(f"{scratch}/round-{step}")
        edges = spark.read.parquet(f"{scratch}/round-{step}")
        step += 1


def _are_stars(edges: DataFrame) -> bool:
    """Whether no node has two links to smaller ones, or links on both sides."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    ends = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not ends.where("up > 1 or (up > 0 and down > 0)").limit(1).count()
