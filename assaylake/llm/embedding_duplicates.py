"""Near-duplicate embeddings by random-hyperplane sign hashing, exact cosines and connected components.

Vectors of one label are linked when their cosine, in double precision, is at least ``cosine``.

1. Equal vectors of one label form one class. Only classes go on.
2. A class lies in one bucket in each of several tables: the signs of its products with the table's random hyperplanes. Hyperplanes and
   tables follow the number of classes, so that buckets stay small, and a pair at the threshold meets in some table but for ``MISSED``.
3. Classes that meet in a bucket and agree in enough signs of a further sketch become candidates of one group. A bucket
   with more than ``BUCKET`` classes isn't compared pair by pair: all of it joins its smallest member's group. So only
   links enough to keep a group together are sent.
4. Groups are connected components of these. Cosines of all pairs of a group are computed by the tasks that
   have its vectors, in blocks; they send the number of links of each class, and the smallest class it is linked with.
5. A group of more than ``GROUP`` classes is cut into rings by the angle to its mean direction. Two angles that together stay within the
   threshold's prove a link, and two that differ by more disprove it, for all pairs of two rings at once; pairs of other rings are compared in blocks. Links are
   reduced to components again.

Defined cases: rows with a NULL id or label, and vectors that are NULL, empty or zero or have NULL or non-finite components, link with nothing
and are kept; a NULL id has a NULL component. Repeated rows are vectors of their own, linked with each other. A shorter
vector is followed by zeros. Empty tables give none. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assaylake.llm import arrays, vectors
from assaylake.llm.components import connected_components, smallest_reachable

MISSED = 1e-3
BUCKET = 256
GROUP = 1024
SKETCH = 64
BIN_ROWS = 4096
_PAIRS = 1 << 20
_ROUNDING = 1e-9


def tables_for(classes: int, cosine: float) -> tuple[int, int]:
    """Hyperplanes of a table, and the number of tables."""
    bits = min(48, max(8, math.ceil(math.log2(max(classes, 1) / 8 + 1))))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(MISSED) / math.log1p(-meet))) if meet < 1 else 1


def most_differing(cosine: float) -> int:
    """Signs of the sketch in which a pair at the threshold differs at most, but for about one time in 10,000."""
    p = math.acos(cosine) / math.pi
    return math.ceil(SKETCH * p + 4 * math.sqrt(SKETCH * p * (1 - p)))


def hyperplanes(width: int, bits: int) -> np.ndarray:
    """A row for each dimension; the first rows are the same for every width."""
    return np.random.default_rng(7).standard_normal((width, bits)) if width else np.zeros((0, bits))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A key of 128 bits for the label and bytes of each vector that can be linked."""
    for batch in batches:
        rows = vectors.matrix(batch.column("vector"), np.float64)
        live = (batch.column("usable").to_numpy(zero_copy_only=False)) & (rows != 0).any(axis=1)
        last = np.where(rows != 0, np.arange(1, rows.shape[1] + 1), 0).max(axis=1, initial=0)
        rows = rows + 0.0  # -0.0 is 0.0
        keys = []
        for i, label in enumerate(batch.column("label").to_pylist()):
            digest = hashlib.blake2b(f"{label}:".encode() + rows[i, : last[i]].tobytes(), digest_size=16)
            keys.append(digest.digest() if live[i] else None)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), batch.column("vector"), pa.array(keys, pa.binary())], names=["id", "label", "vector", "cls"])


def _sketches(bits: int, tables: int):
    """The key of each class's bucket in every table, and its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = vectors.units(vectors.matrix(batch.column("vector"), np.float64))
            planes = hyperplanes(unit.shape[1], SKETCH + bits * tables)
            signs = np.concatenate([unit[i : i + 4096] @ planes >= 0 for i in range(0, len(unit), 4096)])
            sketch = np.packbits(signs[:, :SKETCH], axis=1).view("<i8").ravel()
            label = np.array([int.from_bytes(hashlib.blake2b(str(x).encode(), digest_size=8).digest(), "little") for x in batch.column("label").to_pylist()], np.uint64)
            weights = np.uint64(1) << np.arange(bits, dtype=np.uint64)
            keys = np.empty((len(unit), tables), np.uint64)
            for t in range(tables):
                signature = (signs[:, SKETCH + t * bits : SKETCH + (t + 1) * bits] * weights).sum(axis=1, dtype=np.uint64)
                keys[:, t] = arrays.mix(arrays.mix(label + np.uint64(t)) + signature)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, tables), pa.int32()), pa.array(keys.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sketch), lists], names=["node", "sketch", "buckets"])

    return run


def _meetings(most: int):
    """Links that keep together the members of each bucket whose sketches are close."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column("members")
            flat, sizes = members.flatten(), members.value_lengths().to_numpy().astype(np.int64)
            node, sketch = flat.field("node").to_numpy(), flat.field("sketch").to_numpy().view(np.uint64)
            pairs, first = np.cumsum(sizes * sizes), np.cumsum(sizes) - sizes
            begin = 0
            while begin < len(sizes):
                end = max(begin + 1, int(np.searchsorted(pairs, (pairs[begin - 1] if begin else 0) + _PAIRS, "right")))
                size = sizes[begin:end]
                row = arrays.ragged(first[begin:end], size)
                width = np.repeat(size, size)
                a, b = np.repeat(row, width), arrays.ragged(np.repeat(first[begin:end], size), width)
                near = a < b
                a, b = a[near], b[near]
                near = np.bitwise_count(sketch[a] ^ sketch[b]) <= most
                base = first[begin]
                least = smallest_reachable(a[near] - base, b[near] - base, int(size.sum()))
                inner = np.flatnonzero(least != np.arange(len(least)))
                yield pa.RecordBatch.from_arrays([pa.array(node[inner + base]), pa.array(node[least[inner] + base])], names=["u", "v"])
                begin = end

    return run


def _linked(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    return a @ b.T >= cosine


def _compared(cosine: float):
    """For whole groups: the number of links of each class, and the smallest class of its component."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("grp", "ascending"), ("node", "ascending")]).combine_chunks()
        unit = vectors.units(vectors.matrix(table.column("vector"), np.float64))
        group, node, weight = (table.column(c).to_numpy() for c in ("grp", "node", "weight"))
        at = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
        links, root = np.zeros(len(node), np.int64), node.copy()
        for a, b in zip(at[:-1], at[1:], strict=True):
            near = _linked(unit[a:b], unit[a:b], cosine)
            np.fill_diagonal(near, False)
            links[a:b] = near @ weight[a:b]
            root[a:b] = node[a:b][smallest_reachable(*np.nonzero(np.triu(near)), b - a)]
        return pa.table({"node": node, "links": links, "root": root})

    return run


def _crossed(cosine: float):
    """For two blocks of a group: links of each class across them, and links that keep them together."""

    def run(table: pa.Table) -> pa.Table:
        unit = vectors.units(vectors.matrix(table.column("vector"), np.float64))
        node, weight, side = (table.column(c).to_numpy() for c in ("node", "weight", "side"))
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        own = not len(y)
        y = x if own else y
        near = _linked(unit[x], unit[y], cosine)
        if own:
            np.fill_diagonal(near, False)
        links = np.zeros(len(node), np.int64)
        links[x] += near @ weight[y]
        if not own:
            links[y] += near.T @ weight[x]
        a, b = np.nonzero(near)
        order = np.argsort(node)  # components by node
        rank = np.empty(len(node), np.int64)
        rank[order] = np.arange(len(node))
        least = smallest_reachable(rank[x[a]], rank[y[b]], len(node))
        some = np.flatnonzero(links)
        return pa.table({"node": node[some], "links": links[some], "root": node[order][least[rank[some]]]})

    return run


_LINKS = "node long, links long, root long"


class _Search:
    def __init__(self, rows: DataFrame, scratch: str, cosine: float):
        self.spark, self.scratch, self.cosine = rows.sparkSession, scratch, cosine

    def written(self, frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{self.scratch}/{name}")
        return self.spark.read.parquet(f"{self.scratch}/{name}")

    def groups(self, classes: DataFrame, count: int) -> DataFrame:
        """(node, grp) of classes that may have links."""
        bits, tables = tables_for(count, self.cosine)
        made = classes.select("node", "label", "vector").mapInArrow(_sketches(bits, tables), "node long, sketch long, buckets array<long>")
        made = self.written(made, "sketches")
        posts = made.select("node", "sketch", F.explode("buckets").alias("bucket"))
        held = posts.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("first")).where("n > 1")
        posts = posts.join(held, "bucket")
        hot = posts.where(F.col("n") > BUCKET).select(F.col("node").alias("u"), F.col("first").alias("v")).where("u <> v")
        lists = posts.where(F.col("n") <= BUCKET).groupBy("bucket").agg(F.collect_list(F.struct("node", "sketch")).alias("members"))
        met = lists.select("members").mapInArrow(_meetings(most_differing(self.cosine)), "u long, v long")
        found = connected_components(hot.union(met), f"{self.scratch}/groups", "u", "v")
        return found.select("node", F.col("component").alias("grp"))

    def links(self, classes: DataFrame, count: int) -> DataFrame:
        """(node, links, root) of classes that have links with others."""
        grouped = self.written(self.groups(classes, count), "grouped")
        sizes = self.written(grouped.groupBy("grp").agg(F.count("*").alias("size")), "sizes")
        members = grouped.join(sizes, "grp").join(classes.select("node", "vector", "weight"), "node")
        members = self.written(members, "members")
        small, large = members.where(F.col("size") <= GROUP), members.where(F.col("size") > GROUP)
        numbers = sizes.agg(F.sum(F.when(F.col("size") <= GROUP, F.col("size")).otherwise(0)), F.max("size")).first()
        bins = max(1, -(-(numbers[0] or 0) // BIN_ROWS))
        # many small groups go to one call
        binned = small.withColumn("bin", F.pmod(F.xxhash64("grp"), F.lit(bins))).select("bin", "grp", "node", "weight", "vector")
        found = binned.groupBy("bin").applyInArrow(_compared(self.cosine), _LINKS)
        if (numbers[1] or 0) > GROUP:
            found = found.union(self.large_links(large.select("grp", "node", "weight", "vector")))
        return self.written(found.where("links > 0"), "links")

    def large_links(self, members: DataFrame) -> DataFrame:
        """As ``links``, for groups too large for one block."""
        c = F.col
        angle = math.acos(self.cosine)
        width = angle / 16
        sums = members.mapInArrow(_sums, "grp long, total array<double>").groupBy("grp").applyInArrow(_added, "grp long, pivot array<double>")
        pivots = self.written(sums, "pivots")
        rings = members.join(pivots, "grp").mapInArrow(_rings(width), "grp long, node long, weight long, vector array<double>, ring int")
        rings = self.written(rings, "rings")
        counts = rings.groupBy("grp", "ring").agg(F.count("*").alias("n"), F.sum("weight").alias("w"), F.min("node").alias("first"))
        counts = self.written(counts, "ring-counts").withColumn("blocks", F.ceil(c("n") / GROUP).cast("int"))
        side = lambda s: counts.select("grp", *(c(x).alias(f"{x}_{s}") for x in ("ring", "w", "first", "blocks")))
        both = side("a").join(side("b"), "grp")
        sure = (c("ring_a") + c("ring_b") + 2) * width <= angle - _ROUNDING
        never = (F.abs(c("ring_a") - c("ring_b")) - 1) * width >= angle + _ROUNDING
        # links proved by the rings, and the lowest ring's first class for connection
        proved = both.where(sure).groupBy("grp", c("ring_a").alias("ring")).agg(F.sum("w_b").alias("w"), F.min(F.struct("ring_b", "first_b")).alias("low"))
        known = rings.select("grp", "node", "weight", "ring").join(proved, ["grp", "ring"])
        own = F.when((c("ring") + 1) * 2 * width <= angle - _ROUNDING, c("weight")).otherwise(0)
        known = known.select("node", (c("w") - own).alias("links"), c("low.first_b").alias("root")).where("links > 0")
        # other pairs of rings, block by block
        tasks = both.where(~sure & ~never & (c("ring_a") <= c("ring_b")))
        tasks = tasks.withColumn("block_a", F.explode(F.sequence(F.lit(0), c("blocks_a") - 1))).withColumn("block_b", F.explode(F.sequence(F.lit(0), c("blocks_b") - 1)))
        tasks = tasks.where((c("ring_a") < c("ring_b")) | (c("block_a") <= c("block_b")))
        tasks = self.written(tasks.select("grp", "ring_a", "block_a", "ring_b", "block_b", F.monotonically_increasing_id().alias("task")), "ring-tasks")
        first = tasks.select("grp", c("ring_a").alias("ring"), c("block_a").alias("block"), "task", F.lit(0).alias("side"))
        second = tasks.where((c("ring_a") < c("ring_b")) | (c("block_a") < c("block_b"))).select("grp", "ring_b", "block_b", "task", F.lit(1))
        blocked = rings.join(counts.select("grp", "ring", "blocks"), ["grp", "ring"]).withColumn("block", F.pmod(F.xxhash64("node"), c("blocks")).cast("int"))
        dealt = blocked.join(first.union(second), ["grp", "ring", "block"]).select("task", "side", "node", "weight", "vector")
        crossed = dealt.groupBy("task").applyInArrow(_crossed(self.cosine), _LINKS)
        partial = self.written(known.union(crossed), "large-partial")
        found = connected_components(partial, f"{self.scratch}/large", "node", "root")
        total = partial.groupBy("node").agg(F.sum("links").alias("links"))
        return total.join(found, "node", "left").select("node", "links", F.coalesce("component", "node").alias("root"))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of the unit vectors of each group in a task's batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        unit = vectors.units(vectors.matrix(batch.column("vector"), np.float64))
        group, which = np.unique(batch.column("grp").to_numpy(), return_inverse=True)
        total = np.zeros((len(group), unit.shape[1]))
        np.add.at(total, which, unit)
        at = pa.array(np.arange(0, total.size + 1, total.shape[1]), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(group), pa.ListArray.from_arrays(at, pa.array(total.ravel()))], names=["grp", "total"])


def _added(table: pa.Table) -> pa.Table:
    total = vectors.matrix(table.column("total"), np.float64).sum(axis=0)
    if not total.any():
        total[:1] = 1.0  # any direction will do
    return pa.table({"grp": table.column("grp").slice(0, 1), "pivot": pa.array([total], pa.list_(pa.float64()))})


def _rings(width: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            pivots = vectors.matrix(batch.column("pivot"), np.float64)
            unit = vectors.units(vectors.matrix(batch.column("vector"), np.float64, pivots.shape[1]))
            pivots = vectors.units(np.pad(pivots, ((0, 0), (0, unit.shape[1] - pivots.shape[1]))))
            # the angle by the chord, which is exact for small ones
            angle = 2 * np.arcsin(np.clip(np.sqrt(((unit - pivots) ** 2).sum(axis=1)) / 2, 0, 1))
            ring = np.floor(angle / width).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("grp", "node", "weight")), batch.column("vector").cast(pa.list_(pa.float64())), pa.array(ring)], names=["grp", "node", "weight", "vector", "ring"])

    return run


def near_duplicates(rows: DataFrame, *, scratch: str, id: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = 0.98) -> DataFrame:
    """One row for each row: ``id``, ``n_links`` (other rows linked directly), ``component_id`` (the smallest id reachable over links) and
    ``kept`` (the id is its component's smallest). ``scratch`` is a shared folder."""
    if not 0 < cosine < 1:
        raise ValueError("cosine must lie between 0 and 1")
    search = _Search(rows, scratch, cosine)
    given = rows.select(F.col(id).alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    usable = vectors.finite(F.col("vector")) & F.col("id").isNotNull() & F.col("label").isNotNull()
    given = given.select("id", "label", F.when(usable, F.col("vector")).otherwise(F.array().cast("array<double>")).alias("vector"), usable.alias("usable"))
    kind = given.schema["id"].dataType.simpleString()
    keyed = search.written(given.mapInArrow(_keyed, f"id {kind}, label string, vector array<double>, cls binary"), "keyed")
    classes = keyed.where("cls is not null").groupBy("cls").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("weight"), F.min("id").alias("least")
    )
    classes = search.written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    links = search.links(classes, classes.count())
    known = classes.select("cls", "node", "weight", "least").join(links, "node", "left")
    known = known.withColumn("root", F.coalesce("root", "node"))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(least, "root").select("cls", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"), "component_id")
    out = keyed.select("id", "cls").join(search.written(known, "known"), "cls", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
