"""Benchmark decontamination as a prefix-filtered set join of item windows with document words.

A window is ``n`` consecutive words of an item (or all words of a shorter one); it is a set of short word
shingles, and a document holds it only if it holds all of them. With containment 1 the necessary prefix
of a window is its single rarest shingle. So:

1. one pass over all documents counts the benchmark's shingles, which orders them by rarity;
2. each window is indexed under its rarest shingle, with the shingle's offset in the window;
3. a second pass looks up every document shingle in that index; the offset gives the only place where the
   window could be, bounds drop places that don't fit in the document, and the window's words
   are compared one by one (as 64-bit hashes) at the place that is left.

Documents are never shuffled. The index is broadcast, and its size is bounded: a benchmark of more than
``block_bytes`` of text is split by item into blocks, which the documents pass one after the other.

Defined cases: NULL or wordless texts have no words, hits or items; a NULL item id counts as the empty
string; repeated item ids are one item; repeated documents are each judged for themselves; an empty
benchmark hits nothing. All columns of ``docs`` are passed on; the result is one struct column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from assaylake.llm import arrays
from assaylake.llm.names import unused

# Letters a to z, digits and everything beyond ASCII, after lower-casing A to Z.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_FILTER_BITS = 20


def _words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = arrays.LOWER[buf]
    starts, ends, first = arrays.runs(WORD_BYTE[low], offsets)
    return arrays.span_hashes(low, starts, ends), first


class _Keys:
    """Sorted hashes with a small bitmap that turns most strangers away."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[keys >> np.uint64(64 - _FILTER_BITS)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are keys, and the numbers of those keys."""
        maybe = np.flatnonzero(self.seen[hashes >> np.uint64(64 - _FILTER_BITS)])
        if not len(maybe) or not len(self.keys):
            return maybe[:0], maybe[:0]
        at = np.minimum(np.searchsorted(self.keys, hashes[maybe]), len(self.keys) - 1)
        same = self.keys[at] == hashes[maybe]
        return maybe[same], at[same]


@dataclass
class _Windows:
    """The windows of one block of items."""

    words: np.ndarray  # window x n, hashes
    sizes: np.ndarray
    items: np.ndarray  # of all windows, one after the other
    items_at: np.ndarray
    shingle: int

    def shingles(self) -> dict[int, np.ndarray]:
        """For each shingle length in use, window x offset."""
        out = {}
        for m in {min(self.shingle, int(s)) for s in self.sizes}:
            h = self.words[:, : self.words.shape[1] - m + 1].copy()
            for i in range(1, m):
                h = arrays.mix(h * arrays._STEP + self.words[:, i : i + h.shape[1]])
            out[m] = h
        return out


def _windows(texts: pa.Array, n: int, shingle: int) -> _Windows:
    words, first = _words(*arrays.text_bytes(texts))
    found: dict[bytes, tuple[np.ndarray, set[int]]] = {}
    for item, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
        for start in range(a, max(b - n + 1, a + 1)) if b > a else ():
            window = words[start : min(start + n, b)]
            found.setdefault(window.tobytes(), (window, set()))[1].add(item)
    table = np.zeros((len(found), n), np.uint64)
    for row, (window, _) in zip(table, found.values(), strict=True):
        row[: len(window)] = window
    members = [np.array(sorted(x), np.int64) for _, x in found.values()]
    return _Windows(
        table,
        np.array([len(w) for w, _ in found.values()], np.int64),
        np.concatenate(members) if members else np.zeros(0, np.int64),
        np.concatenate([[0], np.cumsum([len(x) for x in members])]).astype(np.int64),
        shingle,
    )


def _count(keys: dict[int, _Keys]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {m: np.zeros(len(k.keys), np.int64) for m, k in keys.items()}
        for batch in batches:
            for _, buf, offsets in arrays.pieces(batch, "text"):
                words, first = _words(buf, offsets)
                for m, k in keys.items():
                    _, which = k.find(arrays.gram_hashes(words, first, m)[0])
                    totals[m] += np.bincount(which, minlength=len(k.keys))
        for m, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), m, np.int32)), pa.array(at), pa.array(total[at])], names=["m", "k", "n"])

    return run


def _search(windows: _Windows, index: dict[int, tuple[_Keys, np.ndarray, np.ndarray, np.ndarray]], ids: list[str], text: str, names: list[str], counted: bool):
    """``index``: by shingle length the keys, where each key's entries start, and their windows and offsets."""

    def hits(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and windows of all occurrences."""
        places, which = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for m, (keys, at, entry_window, entry_offset) in index.items():
            grams, starts = arrays.gram_hashes(words, first, m)
            found, key = keys.find(grams)
            counts = at[key + 1] - at[key]
            entry = arrays.ragged(at[key], counts)
            window, place = entry_window[entry], np.repeat(starts[found], counts)
            doc = np.searchsorted(first, place, "right") - 1
            place = place - entry_offset[entry]
            fits = (place >= first[doc]) & (place + windows.sizes[window] <= first[doc + 1])
            place, window = place[fits], window[fits]
            for j in range(windows.words.shape[1]):
                beyond = windows.sizes[window] <= j
                same = beyond | (words[np.minimum(place + j, len(words) - 1)] == windows.words[window, j])
                place, window = place[same], window[same]
            places.append(place)
            which.append(window)
        return np.concatenate(places), np.concatenate(which)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, buf, offsets in arrays.pieces(batch, text):
                words, first = _words(buf, offsets)
                place, window = hits(words, first)
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, place, 1)
                np.add.at(edge, place + windows.sizes[window], -1)
                starts, ends, span_at = arrays.runs(np.cumsum(edge[:-1]) > 0, first)
                doc = np.searchsorted(first, place, "right") - 1
                counts = windows.items_at[window + 1] - windows.items_at[window]
                item = windows.items[arrays.ragged(windows.items_at[window], counts)]
                held = np.unique(np.stack([np.repeat(doc, counts), item]), axis=1)
                item_at = np.searchsorted(held[0], np.arange(rows.num_rows + 1))
                owner = np.repeat(np.arange(rows.num_rows), np.diff(span_at))
                spans = pa.StructArray.from_arrays([pa.array(starts - first[owner]), pa.array(ends - first[owner])], ["start", "stop"])
                fresh = [
                    pa.array(np.diff(first)),
                    pa.ListArray.from_arrays(pa.array(span_at, pa.int32()), spans),
                    pa.ListArray.from_arrays(pa.array(item_at, pa.int32()), pa.array([ids[i] for i in held[1]], pa.string())),
                ]
                if counted:
                    old = pa.Table.from_batches([rows]).combine_chunks()
                    fresh[1:] = [_joined(old.column(n).combine_chunks(), x) for n, x in zip(names[-2:], fresh[1:], strict=True)]
                    rows = rows.select([n for n in rows.schema.names if n not in names])
                yield pa.RecordBatch.from_arrays([*rows.columns, *fresh], names=[*rows.schema.names, *names])

    return run


def _joined(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([x + y for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], b.type)


def with_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    n: int = 10,
    shingle: int = 3,
    block_bytes: int = 16 << 20,
    into: str = "leaks",
) -> DataFrame:
    """``docs`` with a struct: ``n_words``, ``n_hit`` (words inside occurrences), ``items`` (ids of items
    with occurring windows, sorted) and ``spans`` (maximal hit runs, as word numbers, end exclusive)."""
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(item_text).cast("string").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    content, *names = unused(docs, "_text", "_words", "_spans", "_items")
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
    kinds = [T.LongType(), T.ArrayType(span), T.ArrayType(T.StringType())]
    out = docs.withColumn(content, F.col(text).cast("string"))
    shape = T.StructType([*out.schema.fields, *map(T.StructField, names, kinds)])
    plain = docs.select(F.col(text).cast("string").alias("text"))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).orderBy("id").toArrow()
        windows = _windows(part.column("text").combine_chunks(), n, shingle)
        grams = windows.shingles()
        inside = {m: np.arange(g.shape[1]) + m <= windows.sizes[:, None] for m, g in grams.items()}
        using = {m: np.minimum(windows.sizes, shingle) == m for m in grams}
        keys = {m: _Keys(np.unique(g[inside[m] & using[m][:, None]])) for m, g in grams.items()}
        counts = {m: np.zeros(len(k.keys), np.int64) for m, k in keys.items()}
        if keys:
            shared = spark.sparkContext.broadcast(keys)
            counted = plain.mapInArrow(lambda batches, s=shared: _count(s.value)(batches), "m int, k long, n long")
            for row in counted.groupBy("m", "k").agg(F.sum("n").alias("n")).collect():  # as many as the block has shingles
                counts[row["m"]][row["k"]] = row["n"]
        index = {}
        for m, g in grams.items():
            which = np.flatnonzero(using[m])
            rare = np.where(inside[m], counts[m][np.minimum(np.searchsorted(keys[m].keys, g), len(keys[m].keys) - 1)], np.iinfo(np.int64).max)[which]
            offset = np.argmin(rare, axis=1)
            entry = g[which, offset]
            order = np.argsort(entry, kind="stable")
            prefix, at = np.unique(entry[order], return_index=True)
            index[m] = (_Keys(prefix), np.append(at, len(entry)), which[order], offset[order])
        shared = spark.sparkContext.broadcast((windows, index, part.column("id").to_pylist()))
        out = out.mapInArrow(lambda batches, s=shared, first=block == 0: _search(*s.value, content, names, not first)(batches), shape)
    spans = F.col(names[1]) if blocks == 1 else _merged(F.col(names[1]))
    hit = F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])
    leaks = F.struct(
        F.col(names[0]).alias("n_words"),
        hit.alias("n_hit"),
        F.sort_array(F.array_distinct(names[2])).alias("items"),
        spans.alias("spans"),
    )
    return out.withColumn(into, leaks).drop(content, *names)


def _merged(spans):
    """Spans of several blocks as maximal runs: sorted by start, and joined where they touch."""
    kind = "array<struct<start:bigint,stop:bigint>>"
    last = lambda done: F.element_at(done, -1)
    grow = lambda done, s: F.when(
        (F.size(done) > 0) & (s["start"] <= F.try_element_at(done, F.lit(-1))["stop"]),
        F.concat(
            F.slice(done, 1, F.size(done) - 1),
            F.array(F.struct(last(done)["start"].alias("start"), F.greatest(last(done)["stop"], s["stop"]).alias("stop"))),
        ),
    ).otherwise(F.concat(done, F.array(s)))
    return F.aggregate(F.sort_array(spans), F.array().cast(kind), grow)
