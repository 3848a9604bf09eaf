"""MinHash near-duplicates by an inverted join over signature coordinates.

A text is the set of its distinct k-word shingles (lower-cased; a shorter text is one shingle of all its
words). Texts are linked when their sets' similarity is at least ``percent`` / 100, and every link is
confirmed on the full sets of shingle fingerprints (48 bits or more; a count is off by one about once in 10^9 pairs).

1. Texts with equal sets form one class (128-bit set fingerprint). Only classes go on.
2. Each class has a signature of ``COORDINATES`` minima. A pair as similar as asked agrees in at least
   ``least_matches`` coordinates (5.2 standard deviations below the mean, so about one in a million is missed).
3. Coordinate-value pairs are counted. Classes are posted under their coordinates, those held by the fewest
   classes first (in steps, ``RARE``): a global order, in which the first ``n - least + shared`` of two similar
   signatures share ``shared`` coordinates. Pairs that meet in short lists are counted, and those at or above the threshold kept.
4. Long lists are not merged pair by pair. Their members are linked with the class that leads most of their lists, and all that
   share a long list are one group of candidates.
5. Pairs are confirmed; they are few for each class, as they come from short lists or lead to a leader.
6. Groups that are not one component then are compared in blocks: classes outside a group's largest component with
   all classes of a similar size. A task counts shared shingles of two blocks by a matrix product and sends one link for each class at
   most. So no group is expanded into its pairs, and no list is cut.

Defined cases: a NULL, empty or blank text has an empty set, links with nothing and is kept. Repeated rows
of one id are one document. A row with a NULL id links with nothing, has a NULL component and is kept. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from assaylake.llm import arrays
from assaylake.llm.components import connected_components, smallest_reachable

COORDINATES = 48
RARE = (4, 8, 32)  # lists of up to so many classes, from the rarest on; longer ones are not posted
SHARED = 3
SET_BYTES = 6
BLOCK_SHINGLES = 1 << 18
_AT_ONCE = 4 << 20  # bytes of sets compared at once
_COLUMNS = 4096

_MULTIPLIERS = arrays.mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(buf: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of each text, with the number of the first one of each text."""
    low = arrays.LOWER[buf]
    starts, ends, first = arrays.runs(~arrays.ASCII_SPACE[low], offsets)
    words = arrays.span_hashes(low, starts, ends)
    counts = np.diff(first)
    grams, _ = arrays.gram_hashes(words, first, k)
    sizes = np.maximum(counts - (k - 1), 0)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if not len(short):
        return grams, np.concatenate([[0], np.cumsum(sizes)])
    sizes[short] = 1
    at = np.concatenate([[0], np.cumsum(sizes)])
    out, whole = np.empty(at[-1], np.uint64), np.zeros(at[-1], bool)
    whole[at[short]] = True
    out[~whole] = grams
    for i in short:
        h = np.uint64(counts[i])
        for w in words[first[i] : first[i + 1]]:
            h = arrays.mix(np.array([h], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + w)[0]
        out[at[i]] = h
    return out, at


def _distinct(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text."""
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[fresh], np.concatenate([[0], np.cumsum(np.bincount(owner[fresh], minlength=len(at) - 1))])


def _fingerprints(hashes: np.ndarray, at: np.ndarray) -> pa.Array:
    """A fingerprint of 128 bits for each set, which is the key of its class."""
    key = np.zeros((len(at) - 1, 2), np.uint64)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        for j in (0, 1):
            key[full, j] = np.add.reduceat(arrays.mix(hashes + np.uint64(j + 1)), at[full])
    return pa.array([x.tobytes() for x in key], pa.binary())


def _signatures(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, buf, offsets in arrays.pieces(batch, "text"):
                hashes, at = _distinct(*shingles(buf, offsets, k))
                sizes = np.diff(at)
                full = np.flatnonzero(sizes)
                low = np.zeros((rows.num_rows, COORDINATES), np.int32)
                if len(full):
                    for j, m in enumerate(_MULTIPLIERS):
                        low[full, j] = (np.minimum.reduceat(hashes * m, at[full]) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                keys = _fingerprints(hashes, at)
                sig = pa.ListArray.from_arrays(pa.array(np.arange(0, low.size + 1, COORDINATES), pa.int32()), pa.array(low.ravel()))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(sizes), keys, sig], names=["doc_id", "n_shingles", "cls", "sig"])

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, buf, offsets in arrays.pieces(batch, "text"):
                hashes, at = _distinct(*shingles(buf, offsets, k))
                packed = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SET_BYTES]
                sets = pa.array([packed[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([_fingerprints(hashes, at), sets], names=["cid", "set"])

    return run


def _unpacked(sets: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of all sets one after the other, and the number of each set's."""
    packed, offsets = arrays.text_bytes(sets)
    wide = np.zeros((len(packed) // SET_BYTES, 8), np.uint8)
    wide[:, :SET_BYTES] = packed.reshape(-1, SET_BYTES)
    return wide.view("<u8").ravel(), np.diff(offsets) // SET_BYTES


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, ends = arrays.text_bytes(batch.column("set_a"))
            _, more = arrays.text_bytes(batch.column("set_b"))
            size, first = ends + more, 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(size, size[first] + _AT_ONCE, "right")) - 1)
                last = min(last, first + 65_536, batch.num_rows)
                some = batch.slice(first, last - first)
                x, nx = _unpacked(some.column("set_a"))
                y, ny = _unpacked(some.column("set_b"))
                pair = np.arange(some.num_rows, dtype=np.uint64) << np.uint64(48)
                keys = np.sort(np.concatenate([x | np.repeat(pair, nx), y | np.repeat(pair, ny)]))
                both = np.bincount((keys[1:][keys[1:] == keys[:-1]] >> np.uint64(48)).astype(np.int64), minlength=some.num_rows)
                keep = np.flatnonzero(100 * both >= percent * (nx + ny - both))
                yield some.select(["a", "b"]).take(pa.array(keep))
                first = last

    return run


def _shared(at: list[np.ndarray], rows: list[np.ndarray], sizes: list[int], tokens: int) -> np.ndarray:
    """How many tokens each row of one block shares with each row of the other. ``at`` are token numbers, ``rows`` their rows."""
    total = np.zeros(sizes, np.float32)
    order = [np.argsort(x, kind="stable") for x in at]
    at, rows = [x[o] for x, o in zip(at, order, strict=True)], [x[o] for x, o in zip(rows, order, strict=True)]
    for first in range(0, tokens, _COLUMNS):
        dense = []
        for x, r, n in zip(at, rows, sizes, strict=True):
            a, b = np.searchsorted(x, [first, first + _COLUMNS])
            part = np.zeros((n, min(_COLUMNS, tokens - first)), np.float32)
            part[r[a:b], x[a:b] - first] = 1
            dense.append(part)
        total += dense[0] @ dense[1].T
    return total


def _compared(percent: int):
    """For two blocks of a group: links that keep together what is similar and not yet connected."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("cid").combine_chunks()
        cid, component, side = (table.column(c).to_numpy() for c in ("cid", "component", "side"))
        shingles, n = _unpacked(table.column("set"))
        row = np.repeat(np.arange(len(cid)), n)
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        y = y if len(y) else x
        place, sides = np.full((2, len(cid)), -1), (x, y)
        for j in (0, 1):
            place[j, sides[j]] = np.arange(len(sides[j]))
        token = np.unique(shingles, return_inverse=True)[1]
        held = [place[j][row] >= 0 for j in (0, 1)]
        there = [np.bincount(token[h], minlength=int(token.max(initial=-1)) + 1) > 0 for h in held]
        number = np.cumsum(there[0] & there[1]) - 1
        common = (there[0] & there[1])[token]
        at = [number[token[h & common]] for h in held]
        both = _shared(at, [place[j][row[held[j] & common]] for j in (0, 1)], [len(x), len(y)], int((there[0] & there[1]).sum()))
        near = (100 * both >= percent * (n[x][:, None] + n[y][None, :] - both)) & (component[x][:, None] != component[y][None, :])
        a, b = np.nonzero(near)
        least = smallest_reachable(x[a], y[b], len(cid))
        some = np.flatnonzero(least != np.arange(len(cid)))
        return pa.table({"a": cid[least[some]], "b": cid[some]})

    return run


def least_matches(percent: int) -> int:
    """Coordinates in which a pair at the threshold agrees but for about one time in a million."""
    p = percent / 100
    return max(1, math.floor(COORDINATES * p - 5.2 * math.sqrt(COORDINATES * p * (1 - p))))


class _Search:
    """The steps of one search; each table that later steps share is written to ``scratch``."""

    def __init__(self, docs: DataFrame, scratch: str, doc_id: str, text: str, k: int, percent: int):
        self.spark, self.scratch, self.k, self.percent = docs.sparkSession, scratch, k, percent
        self.docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
        kind = self.docs.schema["doc_id"].dataType.simpleString()
        rows = self.docs.mapInArrow(_signatures(k), f"doc_id {kind}, n_shingles long, cls binary, sig array<int>")
        self.rows = self.written(rows, "rows")
        classes = self.rows.where("n_shingles > 0 and doc_id is not null").groupBy("cls").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")
        )
        self.classes = self.written(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")

    def written(self, frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{self.scratch}/{name}")
        return self.spark.read.parquet(f"{self.scratch}/{name}")

    def components(self, links: DataFrame, name: str) -> DataFrame:
        return connected_components(links, f"{self.scratch}/{name}")

    def sets(self, wanted: DataFrame, name: str) -> DataFrame:
        """(cid, set) of the classes asked for, from the text of the smallest id of each; an id may have texts of other classes too."""
        some = self.classes.join(wanted, "cid", "left_semi").select("cid", "cls", "doc_id")
        texts = self.docs.join(some.select("doc_id").distinct(), "doc_id", "left_semi")
        sets = texts.mapInArrow(_sets(self.k), "cls binary, set binary")
        return self.written(sets.join(some.select("cid", "cls"), "cls").groupBy("cid").agg(F.first("set").alias("set")), name)

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose full sets are similar enough."""
        pairs = self.written(pairs, "pairs")
        sets = self.sets(pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct(), "sets")
        both = pairs.join(sets.select(F.col("cid").alias("a"), F.col("set").alias("set_a")), "a").join(
            sets.select(F.col("cid").alias("b"), F.col("set").alias("set_b")), "b"
        )
        links = both.select("a", "b", "set_a", "set_b").mapInArrow(_similar(self.percent), "a long, b long")
        return self.written(links, "links")

    def close(self, a: Column, b: Column) -> Column:
        return 100 * F.least(a, b) >= self.percent * F.greatest(a, b)

    def posts(self) -> DataFrame:
        """(cid, coordinate, value, level) of the coordinates under which each class is posted."""
        prefix = COORDINATES - least_matches(self.percent) + SHARED
        elements = self.classes.select("cid", F.posexplode("sig").alias("coordinate", "value"))
        counted = elements.groupBy("coordinate", "value").agg(F.count("*").alias("n")).where(F.col("n") > RARE[0])
        level = sum(((F.col("n") > bound).cast("int") for bound in RARE[1:]), F.lit(1))
        counted = self.written(counted.select("coordinate", "value", level.alias("level")), "counted")
        held = elements.join(counted, ["coordinate", "value"])
        levels = held.groupBy("cid").agg(F.map_from_entries(F.collect_list(F.struct("coordinate", "level"))).alias("levels"))
        at = lambda i: F.coalesce(F.try_element_at("levels", i), F.lit(0))
        ranked = F.sort_array(F.transform("sig", lambda v, i: F.struct(at(i).alias("level"), i.alias("coordinate"), v.alias("value"))))
        posted = self.classes.join(levels, "cid", "left").select("cid", F.explode(F.slice(ranked, 1, prefix)).alias("e"))
        return self.written(posted.select("cid", "e.*"), "posts")

    def links(self) -> DataFrame:
        least = least_matches(self.percent)
        posts = self.posts()
        short = posts.where(F.col("level") < len(RARE))
        met = short.select(F.col("cid").alias("a"), "coordinate", "value").join(
            short.select(F.col("cid").alias("b"), "coordinate", "value"), ["coordinate", "value"]
        )
        met = met.where("a < b").groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= SHARED)
        # seven bits of each minimum tell whether two agree, but for a chance of 1/128 that adds a candidate
        small = F.transform("sig", lambda v: v.bitwiseAND(127).cast("tinyint"))
        of = lambda side: self.classes.select(F.col("cid").alias(side), F.col("n").alias(f"n{side}"), small.alias(f"s{side}"))
        agree = F.aggregate(
            F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, same: total + same
        )

        def matched(candidates: DataFrame) -> DataFrame:
            """Candidates of fitting sizes that agree often enough."""
            both = candidates.join(of("a"), "a").join(of("b"), "b").where(self.close(F.col("na"), F.col("nb")))
            return both.where(agree >= least).select("a", "b")

        long = posts.where(F.col("level") == len(RARE)).select("cid", "coordinate", "value")
        leaders = self.written(long.groupBy("coordinate", "value").agg(F.min("cid").alias("a")), "leaders")
        led = long.join(leaders, ["coordinate", "value"]).where("a < cid").groupBy("a", F.col("cid").alias("b")).agg(F.count("*").alias("n"))
        led = self.written(led, "led")
        stars = led.groupBy("b").agg(F.max_by("a", F.struct("n", "a")).alias("a")).select("a", "b")
        links = self.confirmed(matched(met.select("a", "b").union(stars).distinct()))
        found = self.components(links, "first-components")
        return links.union(self.grouped(self.components(led, "groups"), found))

    def grouped(self, groups: DataFrame, components: DataFrame) -> DataFrame:
        """Links within groups whose classes are not yet one component."""
        c = F.col
        members = groups.select(c("node").alias("cid"), c("component").alias("grp")).join(self.classes.select("cid", "n"), "cid")
        members = members.join(components.select(c("node").alias("cid"), "component"), "cid", "left")
        band = F.floor(F.log(c("n").cast("double")) / math.log(100 / self.percent) + 1e-9).cast("int")
        members = members.select("grp", "cid", "n", F.coalesce("component", "cid").alias("component"), band.alias("band"))
        members = self.written(members, "members")
        sizes = members.groupBy("grp", "component").agg(F.count("*").alias("size"))
        largest = sizes.groupBy("grp").agg(F.max_by("component", F.struct("size", "component")).alias("largest"), F.count("*").alias("parts"))
        largest = self.written(largest.where("parts > 1").select("grp", "largest"), "largest")
        open_ = members.join(largest, "grp").withColumn("outside", c("component") != c("largest"))
        counts = open_.groupBy("grp", "band", "outside").agg(F.sum("n").alias("shingles"))
        counts = counts.select("grp", "band", "outside", F.ceil(c("shingles") / BLOCK_SHINGLES).cast("int").alias("blocks"))
        counts = self.written(counts, "blocks")
        first, second = (counts.select("grp", *(c(x).alias(f"{x}_{s}") for x in ("band", "outside", "blocks"))) for s in "ab")
        both = first.where("outside_a").join(second, "grp").where(F.abs(c("band_a") - c("band_b")) <= 1)
        # of two blocks outside, one order is enough
        both = both.where(~c("outside_b") | (c("band_a") <= c("band_b")))
        both = both.withColumn("block_a", F.explode(F.sequence(F.lit(0), c("blocks_a") - 1))).withColumn("block_b", F.explode(F.sequence(F.lit(0), c("blocks_b") - 1)))
        same = c("outside_b") & (c("band_a") == c("band_b"))
        tasks = both.where(~same | (c("block_a") <= c("block_b"))).withColumn("alone", same & (c("block_a") == c("block_b")))
        tasks = self.written(tasks.withColumn("task", F.monotonically_increasing_id()), "tasks")
        side = lambda s, i: tasks.select("grp", *(c(f"{x}_{s}").alias(x) for x in ("band", "outside", "block")), "task", F.lit(i).alias("side"))
        sides = side("a", 0).union(tasks.where(~c("alone")).select("grp", "band_b", "outside_b", "block_b", "task", F.lit(1)))
        blocked = open_.join(counts, ["grp", "band", "outside"]).withColumn("block", F.pmod(F.xxhash64("cid"), c("blocks")).cast("int"))
        blocked = blocked.join(self.sets(open_.select("cid"), "group-sets"), "cid").select("grp", "band", "outside", "block", "cid", "component", "set")
        dealt = blocked.join(sides, ["grp", "band", "outside", "block"]).select("task", "side", "cid", "component", "set")
        return self.written(dealt.groupBy("task").applyInArrow(_compared(self.percent), "a long, b long"), "group-links")


def near_duplicates(
    docs: DataFrame, *, scratch: str, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id
    reachable over links) and ``kept`` (the id is its component's smallest). ``scratch`` is a shared folder."""
    search = _Search(docs, scratch, doc_id, text, words, percent)
    links = search.links().select("a", "b")
    # a document whose repeated rows differ connects their classes
    rows = search.rows.select("doc_id", "n_shingles", "cls").join(search.classes.select("cls", "cid"), "cls", "left")
    rows = search.written(rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("cid")).alias("cid")), "row-classes")
    several = rows.groupBy("doc_id").agg(F.min("cid").alias("a"), F.max("cid").alias("z")).where("a < z").select("doc_id", "a")
    own = rows.join(several, "doc_id").select("a", F.col("cid").alias("b"))
    found = search.components(links.union(own), "all-components")
    known = search.classes.select("cid", "doc_id").join(found, F.col("cid") == F.col("node"), "left")
    known = known.select("cid", "doc_id", F.coalesce("component", "cid").alias("root"))
    least = known.groupBy("root").agg(F.min("doc_id").alias("least"))
    known = search.written(known.join(least, "root").select("cid", "least"), "known")
    alone = F.coalesce("least", "doc_id")
    return rows.join(known, "cid", "left").select(
        "doc_id", "n_shingles", alone.alias("component_id"), F.coalesce(alone == F.col("doc_id"), F.lit(True)).alias("kept")
    )
