"""Packs: runs of documents kept together, so that several passes over their texts need no shuffle.

Exact search for repeated passages needs a few passes over all texts with small questions and answers in
between. Texts are written once, as rows of about two megabytes (packs), in a table bucketed by pack; each
pass reads it as it lies, and only the questions and answers are shuffled. A question is sent once for each
pack, however many of its documents hold the passage, so hot passages are combined before any shuffle.

A passage is ``window`` consecutive units. Of each window one short gram is chosen (the smallest hash, leftmost
among equals), which depends on the window's content alone. So equal windows choose equal grams, and a
gram that lies in one document only rules out all windows that chose it:

1. packs send their distinct chosen grams, by hash range; the answer is one bit each: held elsewhere too?
2. packs send the distinct segments (windows of one chosen gram) whose grams are shared, by gram; all
   windows that are equal meet in one shard. The answer is one bit for each window: does it start in a
   document with a smaller id than those that hold the segment in this pack?
3. packs mark the units that are covered by such windows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from assaylake.llm import arrays

PACK_BYTES = 2 << 20
SHARD_BYTES = 8 << 20
NO_ID = np.iinfo(np.int64).max


@dataclass
class Units:
    """The units of one pack: bytes that hold them, where each starts and ends there, the number of the first
    unit of each text, and for each place a gram may start its hash."""

    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    grams: np.ndarray


@dataclass(frozen=True)
class Kind:
    """What is compared: ``units`` makes the units of texts, ``smaller`` answers for one shard."""

    window: int
    gram: int
    units: Callable[[np.ndarray, np.ndarray], Units]
    smaller: Callable[[Segments], np.ndarray]
    apart: bool  # units are followed by a space, which is kept between kept units


@dataclass
class Segments:
    """Distinct segments of a shard: their bytes, where each starts, the unit at which the gram starts, the
    number of windows, and the smallest id of a document that holds the segment."""

    buf: np.ndarray
    at: np.ndarray
    gram_at: np.ndarray
    windows: np.ndarray
    doc: np.ndarray


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for rows, _, _ in arrays.pieces(batch, "text", PACK_BYTES):
            ends = pa.array([0, rows.num_rows], pa.int32())
            texts = pa.ListArray.from_arrays(ends, rows.column("text").fill_null(""))
            ids = pa.ListArray.from_arrays(ends, rows.column("doc_id"))
            yield pa.RecordBatch.from_arrays([pa.array([number]), ids, texts], names=["pack", "ids", "texts"])
            number += 1


def write_packs(docs: DataFrame, scratch: str, doc_id: str, text: str) -> tuple[DataFrame, int]:
    """The packs of ``docs`` as bucketed files below ``scratch``, and the number of shards. The files are read by
    buckets without a table in the catalog. Tasks take packs one by one, so buckets may grow beyond the most
    that the session allows; shards don't. The id must be a whole number."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_BYTES))
    table = f"packs_{uuid.uuid4().hex}"
    packs = rows.mapInArrow(_pack, "pack long, ids array<long>, texts array<string>")
    buckets = min(n, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    packs.write.option("path", f"{scratch}/packs").bucketBy(buckets, "pack").saveAsTable(table)
    packs = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the files stay, and the frame has resolved them
    return packs, n


def _chosen(units: Units, kind: Kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that choose the same gram: first and last window (as the number of its first unit), and
    the unit where the gram starts. No window crosses from one text to the next."""
    first, width = units.first, kind.window - kind.gram + 1
    n = int(first[-1])
    if n < kind.window:
        return (np.zeros(0, np.int64),) * 3
    low = np.uint64((1 << 24) - 1)
    key = (units.grams & ~low) | (np.arange(len(units.grams), dtype=np.uint64) & low)
    span, best = 1, key
    while 2 * span <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if span < width:
        best = np.minimum(best[: len(key) - width + 1], best[width - span : width - span + len(key) - width + 1])
    ends = np.repeat(first[1:], np.diff(first))[: len(best)]
    window = np.flatnonzero(np.arange(len(best)) + kind.window <= ends)
    if not len(window):
        return (np.zeros(0, np.int64),) * 3
    place = (best[window] & low).astype(np.int64)
    place += (window >> 24) << 24  # for packs of more units than the low bits hold
    place[place < window] += 1 << 24
    new = np.ones(len(window), bool)
    new[1:] = (place[1:] != place[:-1]) | (window[1:] != window[:-1] + 1)
    at = np.flatnonzero(new)
    return window[at], window[np.append(at[1:], len(window)) - 1], place[at]


def _owner(first: np.ndarray, unit: np.ndarray) -> np.ndarray:
    return np.searchsorted(first, unit, "right") - 1


def _by_bucket(hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes ordered by bucket, where each bucket that has some starts, and its number."""
    distinct = np.unique(hashes)
    bucket = _bucket(distinct, n)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    return distinct[order], np.append(at, len(bucket)), bucket[at]


def _bucket(hashes: np.ndarray, n: int) -> np.ndarray:
    """Shards by the high 24 bits, beside the 40 that are sent."""
    return ((hashes >> np.uint64(40)) % np.uint64(n)).astype(np.int64)


def _contents(batches: Iterator[pa.RecordBatch], kind: Kind):
    for batch in batches:
        for i in range(batch.num_rows):
            buf, offsets = arrays.text_bytes(batch.column("texts")[i].values)
            ids = batch.column("ids")[i].values.fill_null(NO_ID).to_numpy(zero_copy_only=False)
            yield batch, i, ids, kind.units(buf, offsets)


def _bytes_5(hashes: np.ndarray) -> bytes:
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _ask(kind: Kind, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, _, units in _contents(batches, kind):
            hashes, at, buckets = _by_bucket(units.grams[_chosen(units, kind)[2]], n)
            sent = [_bytes_5(hashes[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            pack = pa.array(np.full(len(buckets), batch.column("pack")[i].as_py()))
            yield pa.RecordBatch.from_arrays([pa.array(buckets), pack, pa.array(sent, pa.binary())], names=["bucket", "pack", "sent"])

    return run


def _answer_shared(table: pa.Table) -> pa.Table:
    """One bit for each gram sent: do two packs hold it?"""
    rows = [np.frombuffer(x.as_buffer(), np.uint8).reshape(-1, 5) for x in table.column("sent").combine_chunks()]
    wide = np.zeros((sum(map(len, rows)), 8), np.uint8)
    wide[:, :5] = np.concatenate(rows)
    _, which, count = np.unique(wide.view("<u8").ravel(), return_inverse=True, return_counts=True)
    shared = np.split(count[which] > 1, np.cumsum([len(r) for r in rows])[:-1])
    bits = pa.array([np.packbits(x).tobytes() for x in shared], pa.binary())
    return pa.table({"pack": table.column("pack"), "bucket": table.column("bucket"), "bits": bits})


def _bits(answers, at: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """The bits of all buckets in order. ``answers`` are (bucket, bits) structs."""
    held = {x["bucket"]: x["bits"] for x in answers or ()}
    parts = [np.unpackbits(np.frombuffer(held[k], np.uint8))[: b - a] for k, a, b in zip(buckets.tolist(), at[:-1], at[1:], strict=True)]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


@dataclass
class _Found:
    """Segments of a pack with shared grams: all of them, and the distinct ones ordered by shard."""

    units: Units
    begin: np.ndarray  # first window of each segment
    windows: np.ndarray
    owner: np.ndarray  # number of its document in the pack
    which: np.ndarray  # number of its distinct segment
    sample: np.ndarray  # a segment for each distinct one
    least: np.ndarray  # smallest id of each distinct one
    at: np.ndarray
    shards: np.ndarray
    place: np.ndarray


def _segments(units: Units, ids: np.ndarray, answers, kind: Kind, n: int) -> _Found:
    begin, last, place = _chosen(units, kind)
    grams = units.grams[place]
    hashes, at, buckets = _by_bucket(grams, n)
    shared = _bits(answers, at, buckets)
    order = np.argsort(hashes)
    number = order[np.searchsorted(hashes, grams, sorter=order)] if len(hashes) else np.zeros(0, np.int64)
    owner = _owner(units.first, begin)
    # grams that two documents of this pack hold
    lo, hi = np.full(len(hashes), len(ids)), np.full(len(hashes), -1)
    np.minimum.at(lo, number, owner)
    np.maximum.at(hi, number, owner)
    keep = (shared | (lo < hi))[number]
    begin, last, place, grams, owner = (x[keep] for x in (begin, last, place, grams, owner))
    windows = last - begin + 1
    content = arrays.span_hashes(units.buf, units.starts[begin], units.ends[last + kind.window - 1])
    content = arrays.mix(content + (place - begin).astype(np.uint64))
    _, sample, which = np.unique(content, return_index=True, return_inverse=True)
    shard = _bucket(grams[sample], n)
    order = np.argsort(shard, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    which, sample, shard = rank[which], sample[order], shard[order]
    least = np.full(len(sample), NO_ID)
    np.minimum.at(least, which, ids[owner])
    at = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else np.zeros(0, np.int64)
    return _Found(units, begin, windows, owner, which, sample, least, np.append(at, len(shard)), shard[at], place)


def _answers(batch: pa.RecordBatch, name: str, i: int):
    return batch.column(name)[i].as_py()


def _send(kind: Kind, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, ids, units in _contents(batches, kind):
            found = _segments(units, ids, _answers(batch, "shared", i), kind, n)
            rows = []
            for shard, a, b in zip(found.shards.tolist(), found.at[:-1], found.at[1:], strict=True):
                s = found.sample[a:b]
                start, end = units.starts[found.begin[s]], units.ends[found.begin[s] + found.windows[s] + kind.window - 2]
                size = end - start
                rows.append({
                    "shard": shard, "pack": batch.column("pack")[i].as_py(), "data": units.buf[arrays.ragged(start, size)].tobytes(),
                    "size": size.astype("<i4").tobytes(), "gram_at": (found.place[s] - found.begin[s]).astype("<i2").tobytes(),
                    "windows": found.windows[s].astype("<i2").tobytes(), "doc": found.least[a:b].astype("<i8").tobytes(),
                })
            yield pa.RecordBatch.from_pylist(rows, _SENT)

    return run


_SENT = pa.schema([("shard", pa.int64()), ("pack", pa.int64()), *((x, pa.binary()) for x in ("data", "size", "gram_at", "windows", "doc"))])


def _answer_smaller(kind: Kind):
    def run(table: pa.Table) -> pa.Table:
        column = lambda name, t: [np.frombuffer(x.as_buffer(), t) for x in table.column(name).combine_chunks()]
        size, gram_at, windows, doc = (column(*x) for x in (("size", "<i4"), ("gram_at", "<i2"), ("windows", "<i2"), ("doc", "<i8")))
        buf = np.concatenate(column("data", np.uint8))
        lengths, gram_at, windows, docs = (np.concatenate(x).astype(np.int64) for x in (size, gram_at, windows, doc))
        at = np.concatenate([[0], np.cumsum(lengths)])
        # one of each segment, with the smallest id of any pack
        content = arrays.mix(arrays.span_hashes(buf, at[:-1], at[1:]) + gram_at.astype(np.uint64))
        _, sample, which = np.unique(content, return_index=True, return_inverse=True)
        least = np.full(len(sample), NO_ID)
        np.minimum.at(least, which, docs)
        small = buf[arrays.ragged(at[sample], lengths[sample])]
        ends = np.concatenate([[0], np.cumsum(lengths[sample])])
        segments = Segments(small, ends, gram_at[sample], windows[sample], least)
        best = kind.smaller(segments)  # smallest id for each window of each segment
        first = np.concatenate([[0], np.cumsum(segments.windows)])
        counts = windows
        seen = best[arrays.ragged(first[which], counts)] < np.repeat(docs, counts)
        edges = np.concatenate([[0], np.cumsum(counts)])
        parts = np.cumsum([0, *map(len, size)])
        bits = [np.packbits(seen[edges[a] : edges[b]]).tobytes() for a, b in zip(parts[:-1], parts[1:], strict=True)]
        return pa.table({"pack": table.column("pack"), "bucket": table.column("shard"), "bits": pa.array(bits, pa.binary())})

    return run


def _mark(kind: Kind, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, ids, units in _contents(batches, kind):
            found = _segments(units, ids, _answers(batch, "shared", i), kind, n)
            sizes = found.windows[found.sample]
            edges = np.concatenate([[0], np.cumsum(sizes)])
            smaller = _bits(_answers(batch, "smaller", i), edges[found.at], found.shards)
            count = found.windows
            later = ids[found.owner] > found.least[found.which]
            hit = smaller[arrays.ragged(edges[:-1][found.which], count)] | np.repeat(later, count)
            window = arrays.ragged(found.begin, count)[hit]
            edge = np.zeros(int(units.first[-1]) + 1, np.int64)
            np.add.at(edge, window, 1)
            np.add.at(edge, window + kind.window, -1)
            gone = np.cumsum(edge[:-1]) > 0
            start, end, span_at = arrays.runs(gone, units.first)
            owner = _owner(units.first, start)
            spans = pa.StructArray.from_arrays([pa.array(start - units.first[owner]), pa.array(end - units.first[owner])], ["start", "stop"])
            total = np.concatenate([[0], np.cumsum(gone)])
            kept = np.flatnonzero(~gone)
            size = (units.ends - units.starts)[kept]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, mask=ids == NO_ID),
                    pa.array(np.diff(units.first)),
                    pa.array(np.diff(total[units.first])),
                    pa.ListArray.from_arrays(pa.array(span_at, pa.int32()), spans),
                    _kept(units, kept, size, np.searchsorted(kept, units.first), kind.apart),
                ],
                names=["doc_id", "n_units", "n_removed", "spans", "kept"],
            )

    return run


def _kept(units: Units, kept: np.ndarray, size: np.ndarray, first: np.ndarray, apart: bool) -> pa.Array:
    """The kept units of each text; words are joined by one space."""
    joined = size + 1 if apart else size
    data = units.buf[arrays.ragged(units.starts[kept], joined)]
    at = np.concatenate([[0], np.cumsum(joined)])[first]
    if not apart:
        return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])
    return pa.array([data[a : max(a, b - 1)].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())


def remove_repeats(docs: DataFrame, kind: Kind, scratch: str, doc_id: str, text: str) -> DataFrame:
    """For each document: ``doc_id``, ``n_units``, ``n_removed``, ``spans`` (maximal removed runs, as numbers of
    units, end exclusive) and ``kept`` (bytes). A unit goes if a window that covers it also starts in a
    document with a smaller id."""
    spark = docs.sparkSession
    packs, n = write_packs(docs, scratch, doc_id, text)
    asked = packs.mapInArrow(_ask(kind, n), "bucket long, pack long, sent binary")
    shared = _gathered(asked.groupBy("bucket").applyInArrow(_answer_shared, _ANSWER), "shared", spark, scratch)
    known = packs.join(shared, "pack", "left")
    sent = known.mapInArrow(_send(kind, n), "shard long, pack long, data binary, size binary, gram_at binary, windows binary, doc binary")
    smaller = _gathered(sent.groupBy("shard").applyInArrow(_answer_smaller(kind), _ANSWER), "smaller", spark, scratch)
    marked = known.join(smaller, "pack", "left").mapInArrow(
        _mark(kind, n), "doc_id long, n_units long, n_removed long, spans array<struct<start:long,stop:long>>, kept binary"
    )
    return marked


_ANSWER = "pack long, bucket long, bits binary"


def _gathered(answers: DataFrame, name: str, spark: SparkSession, scratch: str) -> DataFrame:
    """The answers to each pack as one row, written once."""
    answers.groupBy("pack").agg(F.collect_list(F.struct("bucket", "bits")).alias(name)).write.parquet(f"{scratch}/{name}")
    return spark.read.parquet(f"{scratch}/{name}")
