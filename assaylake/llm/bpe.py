"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

A pre-token's leaves are its adjacent pairs, each with the key (rank of the merge, place); the root of the tree
is the leftmost pair of the lowest rank. A merge changes three leaves and the paths above them, until the
root says that no pair can be merged. Pre-tokens of up to 64 bytes are merged side by side, as rows of
numpy arrays with one tree each; longer ones one at a time.

Each distinct pre-token of a run of texts is merged once, and a bounded memory of them is kept for the
task. Distinct pre-tokens are told apart by 64-bit hashes; the ids of each run are decoded again and
compared with its bytes, and a run that differs is encoded by the bytes themselves.

Vocabulary files are JSON files of the tokenizers library: a BPE model, a byte-level pre-tokenizer without
prefix space, and added tokens taken literally. Files that ask for more raise ``ValueError``.

Defined cases: a NULL or empty text has no ids; decoding NULL or no ids gives an empty text, an unknown id
nothing, and bytes that aren't UTF-8 the replacement character. Repeated rows and other columns are passed on.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from assaylake.llm import arrays
from assaylake.llm.names import unused

SIDE_BY_SIDE = 64
MEMORY = 400_000

_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
_NO_KEY = np.iinfo(np.int64).max
# White space of the pre-tokenizer's pattern.
_SPACES = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


@lru_cache(1)
def _classes() -> np.ndarray:
    """The class of each code point."""
    kinds = {"L": _LETTER, "N": _NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[list(_SPACES)] = _SPACE
    return table


def pre_token_starts(points: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Which code points start a pre-token. ``edge`` marks those that start a text (or what follows a literal
    token). The rules are those of the pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``."""
    if not len(points):
        return np.zeros(0, bool)
    kind = _classes()[points]
    start = edge.copy()
    start[1:] |= kind[1:] != kind[:-1]
    # white space before other text: its last character stands alone, a plain space joins what follows
    after = np.flatnonzero(start & ~edge & (kind != _SPACE))
    after = after[kind[after - 1] == _SPACE]
    start[after - 1] = True
    start[after[points[after - 1] == 0x20]] = False
    # contractions, where an apostrophe starts a pre-token of its own
    n = len(points)
    quote = np.flatnonzero(start & (points == ord("'")))
    at = lambda i, c: (points[np.minimum(i, n - 1)] == ord(c)) & (i < n) & ~edge[np.minimum(i, n - 1)]
    one, two = quote + 1, quote + 2
    short = at(one, "s") | at(one, "t") | at(one, "m") | at(one, "d")
    long = (at(one, "r") | at(one, "v")) & at(two, "e") | at(one, "l") & at(two, "l")
    for q, length in ((quote[short], 1), (quote[long & ~short], 2)):
        start[q + 1] = False
        rest = q + 1 + length
        rest = rest[rest < n]
        start[rest[(kind[rest] == _LETTER) & ~edge[rest]]] = True
    return start


class Vocabulary:
    """Merges and tokens of one file."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre, added = spec["model"], spec["pre_tokenizer"], spec["added_tokens"]
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        plain &= spec["normalizer"] is None and pre["type"] == "ByteLevel" and not pre["add_prefix_space"] and pre["use_regex"]
        if not plain or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"{file} asks for more than byte-level BPE")
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        raw = lambda token: bytes(byte_of[c] for c in token)
        ids = model["vocab"]
        self.literals = {t["content"].encode(): t["id"] for t in added}
        tokens = {i: raw(t) for t, i in ids.items()} | {i: t for t, i in self.literals.items()}
        self.bytes_of = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.byte_ids = np.zeros(256, np.int64)
        for b in range(256):
            self.byte_ids[b] = ids[next(c for c, x in byte_of.items() if x == b)]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merged = np.array([ids[a + b] for a, b in merges], np.int64)
        pairs = np.array([(ids[a] << 32) | ids[b] for a, b in merges], np.int64)
        order = np.argsort(pairs, kind="stable")
        pairs, first = np.unique(pairs[order], return_index=True)
        self.pairs, self.ranks = pairs, order[first]
        self.rank_of = dict(zip(pairs.tolist(), self.ranks.tolist(), strict=True))
        self.pool = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.sizes = np.array([len(t) for t in self.bytes_of], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])

    def keys(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        pair = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.ranks[at] * SIDE_BY_SIDE + place, _NO_KEY)

    def bytes_for(self, ids: np.ndarray) -> np.ndarray:
        return self.pool[arrays.ragged(self.at[ids], self.sizes[ids])]


def merge_one(token: bytes, vocabulary: Vocabulary) -> list[int]:
    """The ids of one pre-token of any length."""
    ids = vocabulary.byte_ids[np.frombuffer(token, np.uint8)].tolist()
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    width = 1 << max(0, (n - 2).bit_length())
    none = (1 << 62, 0)
    rank = lambda i: (vocabulary.rank_of.get((ids[i] << 32) | ids[after[i]], 1 << 62), i) if after[i] < n else none
    tree = [none] * width + [rank(i) for i in range(n - 1)] + [none] * (width - max(0, n - 1))
    for i in range(width - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])

    def put(i: int, key: tuple[int, int]) -> None:
        i += width
        tree[i] = key
        while i > 1:
            i //= 2
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

    while n > 1 and tree[1][0] < 1 << 62:
        r, i = tree[1]
        gone = after[i]
        ids[i] = int(vocabulary.merged[r])
        after[i] = after[gone]
        if after[i] < n:
            before[after[i]] = i
        if gone < n - 1:
            put(gone, none)
        put(i, rank(i))
        if before[i] >= 0:
            put(before[i], rank(before[i]))
    out, i = [], 0
    while i < n:
        out.append(ids[i])
        i = after[i]
    return out


def merge_side_by_side(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of many pre-tokens of at most ``SIDE_BY_SIDE`` bytes: all ids, and how many each has."""
    n, longest = len(starts), int(sizes.max(initial=1))
    width = 1 << max(0, (longest - 2).bit_length())
    place = np.arange(longest)
    inside = place < sizes[:, None]
    ids = np.where(inside, vocabulary.byte_ids[buf[np.minimum(starts[:, None] + place, len(buf) - 1)]], -1)
    after = np.broadcast_to(place + 1, ids.shape).copy()
    before = np.broadcast_to(place - 1, ids.shape).copy()
    tree = np.full((n, 2 * width), _NO_KEY)
    if longest > 1:
        paired = inside[:, 1:]
        row, column = np.nonzero(paired)
        tree[row, width + column] = vocabulary.keys(ids[row, column], ids[row, column + 1], column)
        half = width
        while half > 1:
            tree[:, half // 2 : half] = np.minimum(tree[:, half : 2 * half : 2], tree[:, half + 1 : 2 * half : 2])
            half //= 2

    def put(row: np.ndarray, leaf: np.ndarray, key: np.ndarray) -> None:
        node = leaf + width
        tree[row, node] = key
        for _ in range(width.bit_length() - 1):
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    def rank(row: np.ndarray, i: np.ndarray) -> np.ndarray:
        j = after[row, i]
        there = j < sizes[row]
        return np.where(there, vocabulary.keys(ids[row, i], ids[row, np.minimum(j, longest - 1)], i), _NO_KEY)

    row = np.flatnonzero(tree[:, 1] < _NO_KEY)
    while len(row):
        root = tree[row, 1]
        i = root % SIDE_BY_SIDE
        gone = after[row, i]
        ids[row, i] = vocabulary.merged[root // SIDE_BY_SIDE]
        ids[row, gone] = -1
        then = after[row, gone]
        after[row, i] = then
        linked = then < sizes[row]
        before[row[linked], then[linked]] = i[linked]
        leaf = gone < width
        put(row[leaf], gone[leaf], np.full(int(leaf.sum()), _NO_KEY))
        put(row, i, rank(row, i))
        back = before[row, i]
        has = back >= 0
        put(row[has], back[has], rank(row[has], back[has]))
        row = row[tree[row, 1] < _NO_KEY]
    kept = ids >= 0
    return ids[kept], kept.sum(axis=1)


class Encoder:
    """Encodes runs of texts; remembers a bounded number of pre-tokens."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        literals = sorted(vocabulary.literals, key=len, reverse=True)
        self.literal = re.compile(b"|".join(map(re.escape, literals))) if literals else None
        self._forget()

    def _forget(self) -> None:
        self.slots = {t: i for i, t in enumerate(self.vocabulary.literals)}
        self.ids = np.array(list(self.vocabulary.literals.values()), np.int64)
        self.sizes = np.ones(len(self.ids), np.int64)

    def _learn(self, tokens: list[bytes]) -> None:
        small = [t for t in tokens if len(t) <= SIDE_BY_SIDE]
        parts, sizes, learned = [self.ids], [self.sizes], []
        by_width: dict[int, list[bytes]] = {}
        for t in small:
            by_width.setdefault(max(1, (len(t) - 1).bit_length()), []).append(t)
        for group in by_width.values():
            length = np.array([len(t) for t in group], np.int64)
            buf = np.frombuffer(b"".join(group), np.uint8)
            ids, count = merge_side_by_side(buf, np.concatenate([[0], np.cumsum(length)[:-1]]), length, self.vocabulary)
            parts.append(ids)
            sizes.append(count)
            learned += group
        for t in tokens:
            if len(t) > SIDE_BY_SIDE:
                ids = np.array(merge_one(t, self.vocabulary), np.int64)
                parts.append(ids)
                sizes.append(np.array([len(ids)]))
                learned.append(t)
        for t in learned:
            self.slots[t] = len(self.slots)
        self.ids, self.sizes = np.concatenate(parts), np.concatenate(sizes)

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where those of each text start, with the end as the last."""
        starts, ends, first = self._pre_tokens(buf, offsets)
        hashes = arrays.span_hashes(buf, starts, ends)
        _, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        ids, counts = self._look_up(buf, starts[sample], ends[sample], which)
        if not np.array_equal(self.vocabulary.bytes_for(ids), buf):  # two pre-tokens with one hash
            ids, counts = self._look_up(buf, starts, ends, np.arange(len(starts)))
        return ids, np.concatenate([[0], np.cumsum(counts)])[first]

    def _look_up(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data = buf.tobytes()
        tokens = [data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        if len(self.slots) > MEMORY:
            self._forget()
        fresh = list(dict.fromkeys(t for t in tokens if t not in self.slots))
        if fresh:
            self._learn(fresh)
        slot = np.array([self.slots[t] for t in tokens], np.int64)[which]
        at = np.concatenate([[0], np.cumsum(self.sizes)])[slot]
        counts = self.sizes[slot]
        return self.ids[arrays.ragged(at, counts)], counts

    def _pre_tokens(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not len(buf):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        data = buf.tobytes()
        places = np.flatnonzero((buf & 0xC0) != 0x80)  # where each code point starts
        points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
        edge = np.zeros(len(points) + 1, bool)
        edge[np.searchsorted(places, offsets)] = True
        literal = [m.span() for m in self.literal.finditer(data)] if self.literal else []
        texts = np.searchsorted(offsets, [a for a, _ in literal], "right")
        literal = [(a, b) for (a, b), t in zip(literal, texts, strict=True) if b <= offsets[t]]
        for a, b in literal:
            edge[np.searchsorted(places, [a, b])] = True
        start = pre_token_starts(points, edge[:-1])
        for a, b in literal:
            i, j = np.searchsorted(places, [a, b])
            start[i + 1 : j] = False
        starts = places[start]
        return starts, np.append(starts[1:], len(buf)), np.searchsorted(starts, offsets)


@lru_cache(2)
def vocabulary(file: str) -> Vocabulary:
    return Vocabulary(file)


def _encode(file: str, text: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(file))
        for batch in batches:
            for rows, buf, offsets in arrays.pieces(batch, text):
                ids, at = encoder.encode(buf, offsets)
                raw = ids.astype("<u4")
                packed = pa.Array.from_buffers(pa.binary(), rows.num_rows, [None, pa.py_buffer((4 * at).astype(np.int32)), pa.py_buffer(raw)])
                kept = [n for n in rows.schema.names if n != text]
                yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in kept), pa.array(np.diff(at)), packed], names=[*kept, *names])

    return run


def _decode(file: str, ids: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(file)
        for batch in batches:
            texts = []
            for value in batch.column(ids):
                found = np.frombuffer(value.as_py() or b"", "<u4").astype(np.int64)
                texts.append(words.bytes_for(found[found < len(words.sizes)]).tobytes().decode("utf-8", "replace"))
            kept = [n for n in batch.schema.names if n != ids]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(texts, pa.string())], names=[*kept, name])

    return run


def encode(
    docs: DataFrame, file: str, *, text: str = "text", ids: str = "ids", n_tokens: str = "n_tokens", keep_text: bool = True
) -> DataFrame:
    """``docs`` with the ids of each text (little-endian unsigned 32-bit numbers, as bytes) and their number.
    ``file`` must be there on every executor. A column of one of those names is replaced."""
    content, *names = unused(docs, "_text", "_n_tokens", "_ids")
    out = docs.withColumn(content, F.col(text).cast("string")).drop(ids, n_tokens, *([] if keep_text else [text]))
    shape = T.StructType([f for f in out.schema if f.name != content]).add(names[0], T.LongType()).add(names[1], T.BinaryType())
    encoded = out.mapInArrow(_encode(file, content, names), shape)
    return encoded.withColumnsRenamed(dict(zip(names, (n_tokens, ids), strict=True)))


def decode(encoded: DataFrame, file: str, *, ids: str = "ids", text: str = "decoded", keep_ids: bool = True) -> DataFrame:
    """``encoded`` with the text that its ids stand for. A column of that name is replaced."""
    held, name = unused(encoded, "_ids", "_decoded")
    out = encoded.withColumn(held, F.col(ids)).drop(text, *([] if keep_ids else [ids]))
    shape = T.StructType([f for f in out.schema if f.name != held]).add(name, T.StringType())
    return out.mapInArrow(_decode(file, held, name), shape).withColumnRenamed(name, text)


def array_of(ids: str):
    """The ids as an array column, for users who want numbers rather than bytes."""
    byte = lambda i, k: F.hex(F.substring(F.col(ids), 4 * i + (k + 1), F.lit(1)))
    number = lambda i: F.conv(F.concat(*(byte(i, k) for k in (3, 2, 1, 0))), 16, 10).cast("long")
    n = (F.octet_length(ids) / 4).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), number)).otherwise(F.array().cast("array<bigint>"))
