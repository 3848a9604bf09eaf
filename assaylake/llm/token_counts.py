"""Token counts under a unigram lexicon, by dynamic programming over a trie of distinct pre-tokens.

A pre-token is a word (a run without ASCII white space) with the lexicon's space mark before it. Its tokens are
the split into pieces with the highest total score; among equal totals, the one with the fewest pieces. A
character that no piece covers counts as its UTF-8 bytes. The forward score of a prefix depends on the prefix
alone, so the distinct pre-tokens of a run of texts are put in a trie, level by level as numpy arrays, and each
shared prefix is scored once; the number of tokens is read at the node where a pre-token ends.

Scores are whole numbers (thousandths of the natural logarithm), so totals are exact and don't depend on order.
A lexicon is read from a public piece file, which is ordered by frequency; the score of rank r is that of
Zipf's law, -ln(r + 2) up to a constant. Nothing is trained.

Defined cases: a NULL, empty or blank text has no words and no tokens. Repeated rows are counted each for
itself; other columns are passed on. Words longer than ``TRIE_DEPTH`` run the same recurrence one by one.
Distinct words of a run are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from assaylake.llm import arrays
from assaylake.llm.names import unused

TRIE_DEPTH = 128
_R = np.uint64(0x9E3779B97F4A7C15)
_UNIT = 1 << 16  # one thousandth, so that a token fewer wins among equal scores


@dataclass(frozen=True)
class Lexicon:
    """``scores`` by piece; ``byte`` is the score of each byte of a character without a piece."""

    scores: dict[str, int]
    byte: int
    mark: str = "▁"

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.scores), default=1)


@lru_cache(2)
def zipf_lexicon(file: str) -> Lexicon:
    """The pieces of a sentencepiece file (without its control and byte pieces), scored by rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=file)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    scores = {model.id_to_piece(i): -round(1000 * math.log(rank + 2)) for rank, i in enumerate(plain)}
    return Lexicon(scores, min(scores.values(), default=0) - 10_000)


def count_one(word: str, lexicon: Lexicon) -> int:
    """Tokens of one pre-token, by the plain recurrence."""
    longest = lexicon.longest
    best = [(0, 0)]
    for end in range(1, len(word) + 1):
        size = len(word[end - 1].encode())
        value, tokens = best[end - 1]
        top = (value + size * (lexicon.byte * _UNIT - 1), tokens + size)
        for start in range(max(0, end - longest), end):
            score = lexicon.scores.get(word[start:end])
            if score is not None:
                top = max(top, (best[start][0] + score * _UNIT - 1, best[start][1] + 1))
        best.append(top)
    return best[-1][1]


class Trie:
    """Counts the tokens of many pre-tokens at once."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        pieces = [p for p in lexicon.scores if len(p) <= TRIE_DEPTH]
        keys = np.array([self._hash(p) for p in pieces], np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.values = np.array([lexicon.scores[p] * _UNIT - 1 for p in pieces], np.int64)[order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.keys >> np.uint64(44)] = True
        self.longest = max(map(len, pieces), default=1)
        self.powers = np.cumprod(np.append(np.uint64(1), np.full(self.longest, _R, np.uint64)), dtype=np.uint64)

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_R) + ord(c) + 1) & (1 << 64) - 1
        return int(arrays.mix(np.array([h], np.uint64))[0])

    def _piece(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are pieces, and their values."""
        mixed = arrays.mix(hashes)
        maybe = np.flatnonzero(self.seen[mixed >> np.uint64(44)])
        at = np.minimum(np.searchsorted(self.keys, mixed[maybe]), len(self.keys) - 1)
        same = self.keys[at] == mixed[maybe]
        return maybe[same], self.values[at[same]]

    def count(self, points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tokens of each word; ``points`` are code points. Words are at most ``TRIE_DEPTH`` long."""
        # levels hold, for each node, its parent on the level before, the hash of its prefix, value and tokens
        word = np.arange(len(starts))
        node = np.zeros(len(starts), np.int64)
        tokens = np.zeros(len(starts), np.int64)
        levels = [(np.zeros(1, np.int64), np.zeros(1, np.uint64), np.zeros(1, np.int64), np.zeros(1, np.int64))]
        for depth in range(int(sizes.max(initial=0)) + 1):
            char = np.full(len(word), ord(self.lexicon.mark), np.int64) if depth == 0 else points[starts[word] + depth - 1].astype(np.int64)
            pairs, node = np.unique((node << 21) | char, return_inverse=True)
            levels.append(self._level(pairs >> 21, pairs & ((1 << 21) - 1), levels))
            if len(levels) > self.longest + 1:
                levels.pop(0)
            ends = sizes[word] == depth
            tokens[word[ends]] = levels[-1][3][node[ends]]
            word, node = word[~ends], node[~ends]
        return tokens

    def _level(self, parent: np.ndarray, char: np.ndarray, levels: list) -> tuple[np.ndarray, ...]:
        code = np.array([1, 2, 3, 4])[np.searchsorted([0x80, 0x800, 0x10000], char, "right")]
        up, hashes, value, tokens = levels[-1]
        own = hashes[parent] * _R + char.astype(np.uint64) + np.uint64(1)
        best = value[parent] + code * (self.lexicon.byte * _UNIT - 1)
        count = tokens[parent] + code
        ancestor = parent
        for length in range(1, self.longest + 1):
            level = levels[-length]
            found, gain = self._piece(own - level[1][ancestor] * self.powers[length])
            at = ancestor[found]
            total = level[2][at] + gain
            better = total > best[found]
            found, at = found[better], at[better]
            best[found], count[found] = total[better], level[3][at] + 1
            if length == len(levels):
                break
            ancestor = level[0][ancestor]
        return parent, own, best, count


def _points(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points, and the number of the code point at each byte (with the total as the last)."""
    points = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return points, np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])


def _count(lexicon: Lexicon, text: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(lexicon)
        for batch in batches:
            for rows, buf, offsets in arrays.pieces(batch, text, 4 << 20):
                starts, ends, first = arrays.runs(~arrays.ASCII_SPACE[buf], offsets)
                _, sample, which = np.unique(arrays.span_hashes(buf, starts, ends), return_index=True, return_inverse=True)
                points, number = _points(buf)
                begin = number[starts[sample]]
                size = number[ends[sample]] - begin
                tokens = np.zeros(len(sample), np.int64)
                short = np.flatnonzero(size < TRIE_DEPTH)
                tokens[short] = trie.count(points, begin[short], size[short])
                for i in np.flatnonzero(size >= TRIE_DEPTH):
                    word = points[begin[i] : begin[i] + size[i]].tobytes().decode("utf-32-le")
                    tokens[i] = count_one(lexicon.mark + word, lexicon)
                total = np.concatenate([[0], np.cumsum(tokens[which])])
                kept = [n for n in rows.schema.names if n != text]
                counts = [pa.array(np.diff(first)), pa.array(np.diff(total[first]))]
                yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in kept), *counts], names=[*kept, *names])

    return run


def with_token_counts(
    docs: DataFrame, lexicon: Lexicon, *, text: str = "text", n_words: str = "n_words", n_tokens: str = "n_tokens", keep_text: bool = True
) -> DataFrame:
    """``docs`` with the number of words and of tokens of each text. Columns of those names are replaced. The
    lexicon goes to the tasks with the code; its size is that of its file."""
    content, *names = unused(docs, "_text", "_n_words", "_n_tokens")
    out = docs.withColumn(content, F.col(text).cast("string")).drop(n_words, n_tokens, *([] if keep_text else [text]))
    shape = T.StructType([f for f in out.schema if f.name != content] + [T.StructField(n, T.LongType()) for n in names])
    counted = out.mapInArrow(_count(lexicon, content, names), shape)
    return counted.withColumnsRenamed(dict(zip(names, (n_words, n_tokens), strict=True)))
