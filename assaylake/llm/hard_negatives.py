"""Hard negatives by coordinate pruning of inner products, after LEMP.

Components become whole numbers, floor(``scale`` * x), and a row's score is its inner product with an anchor. An anchor's
positives are its best rows of the same label. For each of them the best rows of other labels are
sought whose score lies between ``least_percent`` and ``most_percent`` of the positive's. Higher scores come
first, equal ones by the smaller id. Results are exact.

Rows are dealt by length, longest first, and written once. Anchors go in blocks of at most ``BLOCK_BYTES``, which travel to all rows: a stated query
set against all rows, in blocks. Each task cuts its rows into length buckets; a bucket holds, for each coordinate, the rows in order of
their unit vectors' values. What an anchor still needs is a least score:

1. by length: a bucket whose longest row can't reach the score is skipped;
2. by coordinates: with the angle that the score allows, the value of a row's unit vector at each of the anchor's ``FOCUS``
   largest coordinates lies in a known range of the sorted list; the row sets of these ranges are intersected;
3. what is left is scored exactly, and the least score rises to that of the last row still wanted.

The longest rows come first, alone, so that all tasks start from good least scores. Tasks send at most as many rows as are wanted
for each (anchor, positive), and these are ranked by Spark.

Defined cases: rows with a NULL id, label or vector, or a component that is NULL or not finite, take no part, nor do those
so large that scores might pass 64 bits. An empty vector is zero; a shorter one is followed by zeros. Rows with
the anchor's id are never its positives; repeated rows count as rows. An empty table, or one without anchors, gives no
rows. Columns beyond id, label and vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from assaylake.llm import vectors

BLOCK_BYTES = 8 << 20
BUCKET_ROWS = 8192
TASK_ROWS = 1 << 16
FOCUS = 3
_AT_ONCE = 256
_EXACT = 2.0**53
_MARGIN = 1e-9


@dataclass
class _Wanted:
    """Rows wanted for the anchors of one block, ordered by anchor: for want w rows of anchor ``anchor[w]`` with scores
    from ``least[w]`` to ``most[w]``."""

    ids: np.ndarray
    labels: pa.Array
    anchors: np.ndarray
    anchor: np.ndarray
    least: np.ndarray
    most: np.ndarray
    same: bool  # the anchor's label, or another
    number: int


class _Bucket:
    """Rows of similar length with their sorted coordinate lists."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels, self.rows = ids, labels, rows
        self.wide = rows.astype(np.float64)
        length = np.sqrt((self.wide * self.wide).sum(axis=1))
        self.longest, self.greatest = float(length.max()), float(np.abs(self.wide).max(initial=0))
        unit = (self.wide / np.maximum(length, 1e-300)[:, None]).T.copy()
        self.order = np.argsort(unit, axis=1)
        self.values = np.take_along_axis(unit, self.order, axis=1)
        self.rank = np.empty_like(self.order)
        np.put_along_axis(self.rank, self.order, np.arange(unit.shape[1])[None, :], axis=1)

    def ranges(self, unit: np.ndarray, angle: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each anchor its focus coordinates, and the ranges of their lists that may hold rows within ``angle``."""
        focus = np.argsort(-np.abs(unit), axis=1)[:, :FOCUS]
        at = np.arccos(np.clip(np.take_along_axis(unit, focus, axis=1), -1, 1))
        low, high = np.cos(np.minimum(np.pi, at + angle[:, None])) - _MARGIN, np.cos(np.maximum(0, at - angle[:, None])) + _MARGIN
        begin, end = np.empty(focus.shape, np.int64), np.empty(focus.shape, np.int64)
        for f in np.unique(focus):
            which = focus == f
            begin[which] = np.searchsorted(self.values[f], low[which], "left")
            end[which] = np.searchsorted(self.values[f], high[which], "right")
        return focus, begin, end

    def scores(self, anchors: np.ndarray, some: np.ndarray | None = None) -> np.ndarray:
        """Exact scores of all rows, or of some."""
        size = anchors.shape[1] * self.greatest * float(np.abs(anchors).max(initial=0))
        rows = self.wide if size < _EXACT else self.rows
        rows = rows if some is None else rows[some]
        return (anchors.astype(rows.dtype) @ rows.T).astype(np.int64)

    def found(self, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all pairs that reach the anchors' least scores."""
        wide = anchors.astype(np.float64)
        length = np.maximum(np.sqrt((wide * wide).sum(axis=1)), 1e-300)
        near = least / (length * max(self.longest, 1e-300))
        alive = np.flatnonzero(near <= 1 + _MARGIN)
        out = [(np.zeros(0, np.int64),) * 3]
        if not len(alive):
            return out[0]
        angle = np.arccos(np.clip(near[alive] - _MARGIN, -1, 1)) + _MARGIN
        focus, begin, end = self.ranges(wide[alive] / length[alive, None], angle)
        width = end - begin
        narrow = width.min(axis=1, initial=len(self.ids)) if width.shape[1] else np.full(len(alive), len(self.ids))
        few = 4 * narrow < len(self.ids)
        for i in np.flatnonzero(few):
            f0 = int(width[i].argmin())
            rows = self.order[focus[i, f0]][begin[i, f0] : end[i, f0]]
            for f, a, b in zip(focus[i], begin[i], end[i], strict=True):
                place = self.rank[f][rows]
                rows = rows[(place >= a) & (place < b)]
            score = self.scores(anchors[alive[i]][None, :], rows)[0]
            ok = score >= least[alive[i]]
            out.append((np.full(int(ok.sum()), alive[i]), rows[ok], score[ok]))
        many = np.flatnonzero(~few)
        if len(many):
            inside = np.ones((len(many), len(self.ids)), bool)
            for j in range(focus.shape[1]):
                cut = np.flatnonzero(width[many, j] < len(self.ids))
                place = self.rank[focus[many[cut], j]]
                inside[cut] &= (place >= begin[many[cut], j, None]) & (place < end[many[cut], j, None])
            score = self.scores(anchors[alive[many]])
            a, r = np.nonzero(inside & (score >= least[alive[many], None]))
            out.append((alive[many][a], r, score[a, r]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _buckets(batches: Iterator[pa.RecordBatch], wanted: _Wanted) -> Iterator[_Bucket]:
    held: list[pa.RecordBatch] = []

    def bucket() -> _Bucket:
        table = pa.Table.from_batches(held).combine_chunks()
        rows = vectors.matrix(table.column("vector"), np.int64, wanted.anchors.shape[1])
        return _Bucket(table.column("id").to_numpy(), pc.index_in(table.column("label"), wanted.labels).fill_null(-1).to_numpy(), rows)

    for batch in batches:
        for at in range(0, batch.num_rows, BUCKET_ROWS):
            held.append(batch.slice(at, BUCKET_ROWS))
            if sum(b.num_rows for b in held) >= BUCKET_ROWS:
                yield bucket()
                held = []
    if held and sum(b.num_rows for b in held):
        yield bucket()


def _best(want: np.ndarray, score: np.ndarray, row: np.ndarray, number: int) -> np.ndarray:
    """The places of the best rows of each want."""
    order = np.lexsort((row, -score, want))
    want = want[order]
    first = np.flatnonzero(np.append(True, want[1:] != want[:-1])) if len(want) else np.zeros(0, np.int64)
    rank = np.arange(len(want)) - np.repeat(first, np.diff(np.append(first, len(want))))
    return order[rank < number]


def _search(wanted: _Wanted, labels: np.ndarray):
    """Tasks that send (want, score, id) of the best rows among theirs."""
    starts = np.searchsorted(wanted.anchor, np.arange(len(wanted.ids) + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = wanted.least.copy()
        best = (np.zeros(0, np.int64),) * 3
        width = 0
        for bucket in _buckets(batches, wanted):
            width = max(width, bucket.rows.shape[1])
            anchors = np.pad(wanted.anchors, ((0, 0), (0, width - wanted.anchors.shape[1])))[:, : bucket.rows.shape[1]]
            for a in range(0, len(anchors), _AT_ONCE):
                b = min(a + _AT_ONCE, len(anchors))
                w0, w1 = starts[a], starts[b]
                if w0 == w1:
                    continue
                needs = np.full(b - a, np.iinfo(np.int64).max)
                np.minimum.at(needs, wanted.anchor[w0:w1] - a, least[w0:w1])
                some = np.flatnonzero(np.diff(starts[a : b + 1]))
                anchor, row, score = bucket.found(anchors[a:b][some], needs[some])
                anchor = some[anchor] + a
                equal = bucket.labels[row] == labels[anchor]
                ok = equal & (bucket.ids[row] != wanted.ids[anchor]) if wanted.same else ~equal
                anchor, row, score = anchor[ok], row[ok], score[ok]
                inner = (best[0] >= w0) & (best[0] < w1)
                parts = [tuple(x[inner] for x in best)]
                for j in range(int(np.diff(starts[a : b + 1]).max(initial=0))):
                    want = starts[anchor] + j
                    has = want < starts[anchor + 1]
                    has[has] = (score[has] >= least[want[has]]) & (score[has] <= wanted.most[want[has]])
                    parts.append((want[has], score[has], bucket.ids[row[has]]))
                mixed = tuple(np.concatenate(x) for x in zip(*parts, strict=True))
                keep = _best(mixed[0], mixed[1], mixed[2], wanted.number)
                mixed = tuple(x[keep] for x in mixed)
                best = tuple(np.concatenate([x[~inner], y]) for x, y in zip(best, mixed, strict=True))
                full = np.flatnonzero(np.bincount(mixed[0] - w0, minlength=w1 - w0) >= wanted.number) + w0
                last = np.full(w1 - w0, np.iinfo(np.int64).max)
                np.minimum.at(last, mixed[0] - w0, mixed[1])
                least[full] = np.maximum(least[full], last[full - w0])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in best], names=["want", "score", "id"])

    return run


_FOUND = "want long, score long, id long"


def _collected(rows: DataFrame, wanted: _Wanted, labels: np.ndarray) -> DataFrame:
    found = rows.mapInArrow(_search(wanted, labels), _FOUND)
    order = Window.partitionBy("want").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted.number)


def _raised(first: DataFrame, wanted: _Wanted, labels: np.ndarray) -> _Wanted:
    """What the first bucket already gives raises the least scores."""
    found = _collected(first, wanted, labels).groupBy("want").agg(F.min("score").alias("last"), F.count("*").alias("n"))
    last = found.where(F.col("n") == wanted.number).select("want", "last").toArrow()
    want, least = last.column("want").to_numpy(), wanted.least.copy()
    least[want] = np.maximum(least[want], last.column("last").to_numpy())
    return _Wanted(**{**vars(wanted), "least": least})


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    *,
    scratch: str,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    least_percent: int = 30,
    most_percent: int = 90,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score`` and ``negative_score``. ``anchors`` tells which rows
    are anchors. ``scratch`` is a shared folder."""
    spark = rows.sparkSession
    v = F.col(vector)
    floors = F.transform(v, lambda x: F.floor(x.cast("double") * scale))
    # products of all components together stay below 2^62
    fits = F.forall("vector", lambda x: (F.abs(x.cast("double")) * F.sqrt(F.greatest(F.size("vector"), F.lit(1)))) < 2.0**31)
    used = rows.where(F.col(id).isNotNull() & F.col(label).isNotNull() & vectors.finite(v)).select(
        F.col(id).cast("long").alias("id"), F.col(label).alias("label"), floors.alias("vector"), F.coalesce(anchors, F.lit(False)).alias("anchor")
    )
    used = used.where(fits).withColumn("length", F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    used.write.parquet(f"{scratch}/used")
    used = spark.read.parquet(f"{scratch}/used")
    size = used.agg(F.count("*"), F.sum(F.col("anchor").cast("long")), F.max(F.when(F.col("anchor"), F.size("vector")))).first()
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-size[0] // TASK_ROWS))
    dealt = used.repartitionByRange(parts, F.desc("length"), "id").sortWithinPartitions(F.desc("length"))
    dealt.select("id", "label", "vector", "length").write.parquet(f"{scratch}/rows")
    dealt = spark.read.parquet(f"{scratch}/rows")
    first = dealt.orderBy(F.desc("length"), "id").limit(BUCKET_ROWS).select("id", "label", "vector")
    first.write.parquet(f"{scratch}/first")
    first, dealt = spark.read.parquet(f"{scratch}/first").coalesce(1), dealt.select("id", "label", "vector")

    blocks = -(-(size[1] or 0) * 8 * max(size[2] or 0, 1) // block_bytes)
    used.where("anchor").select("id", "label", "vector", F.pmod(F.monotonically_increasing_id(), F.lit(max(1, blocks))).alias("block")).write.parquet(f"{scratch}/anchors")
    for block in range(blocks):
        table = spark.read.parquet(f"{scratch}/anchors").where(F.col("block") == block).toArrow()
        if not table.num_rows:
            continue
        ids, matrix = table.column("id").to_numpy(), vectors.matrix(table.column("vector"), np.int64)
        known = pc.unique(table.column("label").combine_chunks())
        labels = pc.index_in(table.column("label"), known).to_numpy()
        n = len(ids)
        low, high = np.full(n, np.iinfo(np.int64).min), np.full(n, np.iinfo(np.int64).max)
        wanted = _Wanted(ids, known, matrix, np.arange(n), low, high, True, positives)
        found = _collected(dealt, _raised(first, wanted, labels), labels).orderBy("want", "rank").toArrow()
        anchor, score, other = (found.column(c).to_numpy() for c in ("want", "score", "id"))
        # 100 * score from least_percent to most_percent of the positive's
        whole, rest = score // 100, score % 100
        low, high = least_percent * whole - (-least_percent * rest) // 100, most_percent * whole + most_percent * rest // 100
        ok = low <= high
        anchor, score, other, low, high = (x[ok] for x in (anchor, score, other, low, high))
        if not len(anchor):
            continue
        wanted = _Wanted(ids, known, matrix, anchor, low, high, False, negatives)
        best = _collected(dealt, _raised(first, wanted, labels), labels)
        pairs = pa.table({"want": np.arange(len(anchor)), "anchor_id": ids[anchor], "positive_id": other, "positive_score": score})
        best = best.join(spark.createDataFrame(pairs), "want").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
        best.write.mode("append").parquet(f"{scratch}/found")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(f"{scratch}/found")
    return spark.read.schema(schema).parquet(f"{scratch}/found")
