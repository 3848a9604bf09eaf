"""Exact removal of repeated byte strings with suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts in a document with a smaller id goes. Texts
are compared as UTF-8; matches never cross documents; strings are judged on the input.

Candidate segments come from ``packs`` (strings that share a chosen gram with another document, found with no
loss). A shard's segments that share their gram with another are sorted in blocks: each block gets a suffix array by Larsson-Sadakane refinement
(ranks double the sorted length; only groups not yet sorted are touched) and Kasai's common prefixes, all
segments side by side in numpy. Neighbours that share ``length`` bytes are one string. The sorted strings of
the blocks are merged by binary search, which gives each string its smallest document.

Defined cases: a NULL or empty text has no bytes and nothing is removed. Rows with one id don't remove each
other's bytes. A NULL id counts as larger than all others. ``kept`` is binary, as cuts may split characters.
Segments are told apart by 64-bit hashes when copies are combined; strings are compared byte by byte.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame

from assaylake.llm import arrays, packs

BLOCK_BYTES = 1 << 20
GRAM = 24


def _order_of_pairs(first: np.ndarray, second: np.ndarray, most: int) -> np.ndarray:
    """The order of pairs of numbers up to ``most``, equal ones by place. Where both and the place fit into one
    number, its plain sort is several times as fast."""
    bits = int(most).bit_length()
    if 3 * bits > 63:
        return np.lexsort((second, first))
    packed = (first << 2 * bits) | (second << bits) | np.arange(len(first))
    packed.sort()
    return packed & ((1 << bits) - 1)


def suffix_order(text: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The suffixes (each up to its ``end``) in order; equal ones by place."""
    n = len(text)
    size = np.minimum(end - np.arange(n), 7)
    mask = ~np.uint64(0) << (64 - 8 * size).astype(np.uint64)
    key = (arrays.lanes(text)[:n].byteswap() & mask) | size.astype(np.uint64)
    order = np.argsort(key, kind="stable")
    fresh = np.append(True, key[order][1:] != key[order][:-1])
    rank = np.zeros(n + 1, np.int64)  # the place of a group's first suffix, from 1 on; 0 is past the end
    rank[order] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1] + 1
    longest, done = int((end - np.arange(n)).max(initial=0)), 7
    unsorted = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
    while done < longest and len(unsorted):
        sub = order[unsorted]
        there = sub + done
        first, second = rank[sub], np.where(there < end[sub], rank[np.minimum(there, n)], 0)
        by = _order_of_pairs(first, second, n)
        sub, first, second = sub[by], first[by], second[by]
        order[unsorted] = sub
        fresh = np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]))
        rank[sub] = unsorted[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]] + 1
        unsorted = unsorted[~(fresh & np.append(fresh[1:], True))]
        done *= 2
    return order


def common_prefixes(text: np.ndarray, end: np.ndarray, order: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bytes that each suffix shares with the one before it, by Kasai's rule that the next suffix of a text
    shares at most one byte less. All segments (starting at ``at``) advance together."""
    n = len(text)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    shared = np.zeros(n, np.int64)
    size = np.diff(at)
    carried = np.zeros(len(size), np.int64)
    for step in range(int(size.max(initial=0))):
        segment = np.flatnonzero(size > step)
        suffix = at[segment] + step
        where = place[suffix]
        h = np.where(where > 0, carried[segment], 0)
        other = order[np.maximum(where - 1, 0)]
        going = np.flatnonzero(where > 0)
        while len(going):
            a, b = suffix[going] + h[going], other[going] + h[going]
            inside = (a < end[suffix[going]]) & (b < end[other[going]])
            same = inside & (text[np.minimum(a, n - 1)] == text[np.minimum(b, n - 1)])
            going = going[same]
            h[going] += 1
        shared[where] = h
        carried[segment] = np.maximum(h - 1, 0)
    return shared


def _block(segments: packs.Segments, a: int, b: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct strings of segments ``a`` to ``b`` in order, their smallest ids, and the string of each window."""
    text, at = segments.buf[segments.at[a] : segments.at[b]], segments.at[a : b + 1] - segments.at[a]
    size = np.diff(at)
    end = np.repeat(at[1:], size)
    order = suffix_order(text, end)
    group = np.cumsum(common_prefixes(text, end, order, at) < length)
    of = np.empty(len(text), np.int64)
    of[order] = group
    windows = segments.windows[a:b]
    start = arrays.ragged(at[:-1], windows)
    _, sample, which = np.unique(of[start], return_index=True, return_inverse=True)
    least = np.full(len(sample), packs.NO_ID)
    np.minimum.at(least, which, np.repeat(segments.doc[a:b], windows))
    strings = np.ones((len(sample), length + 1), np.uint8)  # a last byte of 1, as numpy drops zeros at the end
    strings[:, :length] = text[start[sample][:, None] + np.arange(length)]
    return strings.reshape(-1).view(f"S{length + 1}") if len(sample) else np.zeros(0, f"S{length + 1}"), least, which


def smallest_ids(segments: packs.Segments, length: int) -> np.ndarray:
    """For each window of each segment, the smallest id of a document in the shard that holds its string."""
    edges = [0]
    while edges[-1] < len(segments.windows):
        far = np.searchsorted(segments.at, segments.at[edges[-1]] + BLOCK_BYTES, "right") - 1
        edges.append(max(edges[-1] + 1, int(far)))
    blocks = [_block(segments, a, b, length) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    if not blocks:
        return np.zeros(0, np.int64)
    strings, least, _ = blocks[0]
    for more, ids, _ in blocks[1:]:
        at = np.searchsorted(strings, more)
        same = strings[np.minimum(at, len(strings) - 1)] == more
        np.minimum.at(least, at[same], ids[same])
        strings, least = np.insert(strings, at[~same], more[~same]), np.insert(least, at[~same], ids[~same])
    return np.concatenate([least[np.searchsorted(strings, own)][which] for own, _, which in blocks])


def smallest_shared_ids(segments: packs.Segments, length: int) -> np.ndarray:
    """As ``smallest_ids``, for segments whose windows all hold the gram at ``gram_at``. Windows that are equal chose
    the same gram, so a segment whose gram no other has meets nothing and isn't sorted."""
    best = np.repeat(segments.doc, segments.windows)
    begin = segments.at[:-1] + segments.gram_at
    _, which, count = np.unique(arrays.span_hashes(segments.buf, begin, begin + GRAM), return_inverse=True, return_counts=True)
    some = np.flatnonzero(count[which] > 1)
    if not len(some):
        return best
    size, windows = np.diff(segments.at)[some], segments.windows[some]
    buf = segments.buf[arrays.ragged(segments.at[some], size)]
    met = packs.Segments(buf, np.concatenate([[0], np.cumsum(size)]), segments.gram_at[some], windows, segments.doc[some])
    first = np.cumsum(segments.windows) - segments.windows
    best[arrays.ragged(first[some], windows)] = smallest_ids(met, length)
    return best


def byte_units(buf: np.ndarray, offsets: np.ndarray) -> packs.Units:
    place = np.arange(len(buf))
    n = max(0, len(buf) - GRAM + 1)
    load = arrays.lanes(buf)
    h = np.zeros(n, np.uint64)
    for i in range(0, GRAM, 8):
        h = arrays.mix(h + load[i : i + n] * arrays._STEP) if n else h
    return packs.Units(buf, place, place + 1, offsets, h)


def remove_repeated_strings(docs: DataFrame, *, scratch: str, doc_id: str = "doc_id", text: str = "text", length: int = 50) -> DataFrame:
    """``doc_id``, ``n_units`` (bytes), ``n_removed``, ``spans`` (maximal removed runs of bytes) and ``kept``
    (binary) of every document. ``length`` must be over 31. ``scratch`` is a shared folder."""
    if length < GRAM + 8:
        raise ValueError(f"length must be at least {GRAM + 8}")
    kind = packs.Kind(length, GRAM, byte_units, partial(smallest_shared_ids, length=length), apart=False)
    return packs.remove_repeats(docs, kind, scratch, doc_id, text)
