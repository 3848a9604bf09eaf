"""Exact removal of repeated passages with Aho-Corasick automata over confirmed phrases.

A word goes if a window of ``length`` consecutive words that covers it also starts in a document with a smaller
id. Words are runs without ASCII white space, unchanged; windows are judged on the input.

Candidate segments come from ``packs``. Each shard confirms which phrases (half-window grams that segments
were sent for) recur in different segments, compiles them into automata of bounded size with pyahocorasick,
and streams its segments through them; every occurrence found byte by byte anchors the windows around it,
and windows with the same words take the smallest id of their documents.

Defined cases: a NULL, empty or blank text has no words. Rows with one id don't remove each other's words.
A NULL id counts as larger than all others. Kept words are joined by one space. Phrases are compared byte by
byte; the words around them, and segments when copies are combined, by 64-bit hashes.
"""

from __future__ import annotations

from functools import partial

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame, functions as F

from assaylake.llm import arrays, packs

AUTOMATON_BYTES = 1 << 20
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def rolling(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of the ``n`` words from each place on, by differences of running sums."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _powers(_FACTOR, len(words)), dtype=np.uint64)])
    return arrays.mix((total[n:] - total[:-n]) * _powers(_INVERSE, len(words) - n + 1))


def word_units(buf: np.ndarray, offsets: np.ndarray, gram: int) -> packs.Units:
    """Words, each followed by one space."""
    starts, ends, first = arrays.runs(~arrays.ASCII_SPACE[buf], offsets)
    size = ends - starts
    joined = np.append(buf, np.uint8(0x20))[arrays.ragged(starts, size + 1)]
    at = np.concatenate([[0], np.cumsum(size + 1)])
    joined[at[1:] - 1] = 0x20
    starts, ends = at[:-1], at[1:] - 1
    return packs.Units(joined, starts, ends, first, rolling(arrays.span_hashes(joined, starts, ends), gram))


def _occurrences(phrases: list[str], stream: str):
    """(start, phrase number) of every occurrence, one automaton of bounded size after the other."""
    first = 0
    while first < len(phrases):
        automaton, size, last = ahocorasick.Automaton(), 0, first
        while last < len(phrases) and (last == first or size + len(phrases[last]) <= AUTOMATON_BYTES):
            automaton.add_word(phrases[last], last)
            size += len(phrases[last])
            last += 1
        automaton.make_automaton()
        for end, number in automaton.iter(stream):
            yield end - len(phrases[number]) + 1, number
        first = last


def smallest_ids(segments: packs.Segments, length: int, gram: int) -> np.ndarray:
    """For each window of each segment, the smallest id of a document in the shard that holds its words."""
    n = len(segments.windows)
    starts, ends, first = arrays.runs(segments.buf != 0x20, segments.at)
    windows = segments.windows
    best = np.repeat(segments.doc, windows)
    # phrases that several segments were sent for
    begin = first[:-1] + segments.gram_at
    own = arrays.span_hashes(segments.buf, starts[begin], ends[begin + gram - 1])
    _, sample, which, count = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
    recurring = np.flatnonzero(count > 1)
    # one character stands for one byte; spaces around phrases and segments keep words whole
    text = segments.buf.tobytes().decode("latin-1")
    phrases = [f" {text[starts[begin[s]] : ends[begin[s] + gram - 1]]} " for s in sample[recurring]]
    members = np.flatnonzero((count > 1)[which])
    if not len(members):
        return best
    stream = "".join(f" {text[segments.at[s] : segments.at[s + 1]]} \n" for s in members)
    width = segments.at[members + 1] - segments.at[members] + 3
    origin = np.concatenate([[0], np.cumsum(width)])
    found = np.array([start for start, _ in _occurrences(phrases, stream)], np.int64)
    segment = np.searchsorted(origin, found, "right") - 1
    byte = segments.at[members[segment]] + found - origin[segment]  # where the phrase's first word starts
    word = np.searchsorted(starts, byte)
    segment = members[segment]
    offset = word - first[segment]
    # windows around each occurrence, each once
    low, high = np.maximum(offset - (length - gram), 0), np.minimum(offset, windows[segment] - 1)
    edge = np.concatenate([[0], np.cumsum(windows)])
    has = high >= low
    seen = np.unique(arrays.ragged(edge[segment[has]] + low[has], high[has] - low[has] + 1))
    owner = np.searchsorted(edge, seen, "right") - 1
    place = first[owner] + seen - edge[owner]
    content = rolling(arrays.span_hashes(segments.buf, starts, ends), length)[place]
    _, group = np.unique(content, return_inverse=True)
    least = np.full(int(group.max(initial=-1)) + 1, packs.NO_ID)
    np.minimum.at(least, group, segments.doc[owner])
    best[seen] = least[group]
    assert n == len(first) - 1
    return best


def remove_repeated_passages(docs: DataFrame, *, scratch: str, doc_id: str = "doc_id", text: str = "text", length: int = 50) -> DataFrame:
    """``doc_id``, ``n_units`` (words), ``n_removed``, ``spans`` (maximal removed runs of words) and ``kept`` (a
    string) of every document. ``length`` is at least 2. ``scratch`` is a shared folder."""
    gram = length // 2
    kind = packs.Kind(length, gram, partial(word_units, gram=gram), partial(smallest_ids, length=length, gram=gram), apart=True)
    out = packs.remove_repeats(docs, kind, scratch, doc_id, text)
    return out.withColumn("kept", F.decode("kept", "UTF-8"))
