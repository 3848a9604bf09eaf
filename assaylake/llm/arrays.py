"""Texts of an Arrow batch as numpy arrays: bytes, words and hashes, without a Python loop over words.

A NULL text is an empty one. Hashes are 64-bit and well mixed; operators that must not err confirm what
hashes suggest, or state the odds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and where each starts, with the end as the last."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str, most_bytes: int = 2 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """A batch in runs of whole rows of about ``most_bytes`` (a longer text is a run of its own), each
    with its bytes and offsets. Small runs keep the arrays in the processor's cache."""
    buf, offsets = text_bytes(batch.column(text))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most_bytes, "right")) - 1)
        last = min(last, batch.num_rows)
        yield batch.slice(first, last - first), buf[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes marked in ``inside``, none across texts: starts, ends, and for each text the
    number of the first run (with the total as the last)."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(inside))]
    before[edges] = False
    after[edges - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lanes(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one little-endian number, with zeros past the end."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    return np.ndarray((len(buf) + 1,), "<u8", padded, 0, (1,))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span."""
    load, length = lanes(buf), ends - starts
    h = length.astype(np.uint64) * _STEP
    todo, at = np.arange(len(starts)), starts
    while len(todo):
        left = length[todo]
        h[todo] = mix((h[todo] + _STEP) ^ (load[at] & _MASKS[np.minimum(left, 8)]))
        more = left > 8
        todo, at = todo[more], at[more] + 8
        length = length - 8
    return h


def gram_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` consecutive words of one text, and the number of the word each starts with."""
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = words[: len(words) - n + 1].copy()
    for i in range(1, n):
        h = mix(h * _STEP + words[i : len(words) - n + 1 + i])
    counts = np.diff(first)
    ends = np.repeat(first[1:], counts)[: len(h)]
    at = np.flatnonzero(np.arange(len(h)) + n <= ends)
    return h[at], at


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start and count, one after the other."""
    total = int(counts.sum())
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else starts, counts)
    return shift + np.arange(total)
