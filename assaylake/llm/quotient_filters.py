"""Counting quotient filters over whole, permuted keys: counters that lose nothing.

A key is a number of ``2 * half`` bits, held as two halves. An invertible permutation (four Feistel rounds) spreads
keys evenly. The first bits of the permuted key name its shard, the next ones are the quotient, and all others
are kept as the remainder. So a filter tells every key from every other, and keys come back by undoing the permutation.

A filter of ``m`` keys has about ``m`` quotients. It holds, in order of the keys: one bit for each quotient and each key
(how many keys share a quotient), the remainders in whole bytes, and the counts in bytes, with those over 254 apart.
Filters of one shard are merged by their order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard

from assaylake.llm import arrays

_ROUNDS = tuple(np.uint64(r * 0x9E3779B97F4A7C15 & (1 << 64) - 1) for r in range(1, 5))


@dataclass
class Counter:
    """Distinct keys in order of their permuted halves, and their counts."""

    high: np.ndarray
    low: np.ndarray
    counts: np.ndarray


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def permute(high: np.ndarray, low: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    for key in _ROUNDS:
        high, low = low, high ^ (arrays.mix(low + key) & _mask(half))
    return high, low


def restore(high: np.ndarray, low: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    for key in reversed(_ROUNDS):
        high, low = low ^ (arrays.mix(high + key) & _mask(half)), high
    return high, low


def counted(high: np.ndarray, low: np.ndarray, half: int, counts: np.ndarray | None = None) -> Counter:
    """The distinct keys of permuted halves with the sums of their counts (each 1 if None are given)."""
    top = (high << np.uint64(half)) | low if 2 * half <= 64 else (high << np.uint64(64 - half)) | (low >> np.uint64(2 * half - 64))
    if counts is None and 2 * half <= 64:
        top, counts = np.unique(top, return_counts=True)
        return Counter(top >> np.uint64(half), top & _mask(half), counts)
    order = np.argsort(top)
    high, low, top = high[order], low[order], top[order]
    if 2 * half > 64 and np.any((top[1:] == top[:-1]) & (low[1:] != low[:-1])):  # equal in 64 bits only
        again = np.lexsort((low, high))
        order, high, low = order[again], high[again], low[again]
    fresh = np.ones(len(high), bool)
    fresh[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    at = np.flatnonzero(fresh)
    if counts is None:
        total = np.diff(np.append(at, len(high)))
    else:
        total = np.add.reduceat(counts[order], at) if len(at) else np.zeros(0, np.int64)
    return Counter(high[at], low[at], total)


def _width(bits: int) -> int:
    return -(-bits // 8)


def _to_bytes(values: np.ndarray, width: int) -> np.ndarray:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].ravel()


def _from_bytes(data: np.ndarray, width: int, m: int) -> np.ndarray:
    wide = np.zeros((m, 8), np.uint8)
    wide[:, :width] = data.reshape(m, width)
    return wide.view("<u8").ravel()


def dump(counter: Counter, half: int, shard_bits: int) -> bytes:
    """A filter of keys of one shard."""
    m, rest = len(counter.high), half - shard_bits
    q = min(rest, max(m, 1).bit_length() - 1)
    high = counter.high & _mask(rest)
    quotient = (high >> np.uint64(rest - q)).astype(np.int64)
    runs = np.zeros((1 << q) + m, bool)
    runs[quotient + np.arange(m)] = True
    many = np.flatnonzero(counter.counts >= 255)
    parts = [
        np.array([m, len(many)], "<i8").view(np.uint8),
        np.packbits(runs),
        _to_bytes(high & _mask(rest - q), _width(rest - q)),
        _to_bytes(counter.low, _width(half)),
        np.minimum(counter.counts, 255).astype(np.uint8),
        counter.counts[many].astype("<i8").view(np.uint8),
    ]
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate(parts).tobytes())


def load(data: bytes, half: int, shard_bits: int, shard: int) -> Counter:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    m, many = raw[:16].view("<i8").tolist()
    rest = half - shard_bits
    q = min(rest, max(m, 1).bit_length() - 1)
    sizes = (_width((1 << q) + m), m * _width(rest - q), m * _width(half), m, 8 * many)
    runs, remainder, low, counts, over = np.split(raw[16:], np.cumsum(sizes)[:-1])
    quotient = np.flatnonzero(np.unpackbits(runs)) - np.arange(m)
    high = (np.uint64(shard) << np.uint64(rest)) | (quotient.astype(np.uint64) << np.uint64(rest - q))
    counts = counts.astype(np.int64)
    counts[counts == 255] = over.view("<i8")
    return Counter(high | _from_bytes(remainder, _width(rest - q), m), _from_bytes(low, _width(half), m), counts)


def split(counter: Counter, half: int, shard_bits: int):
    """(shard, its part) for each shard that has keys."""
    shard = counter.high >> np.uint64(half - shard_bits)
    at = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else np.zeros(0, np.int64)
    for a, b in zip(at, [*at[1:], len(shard)] if len(at) else at, strict=True):
        yield int(shard[a]), Counter(counter.high[a:b], counter.low[a:b], counter.counts[a:b])


def merge(counters: list[Counter], half: int) -> Counter:
    return counted(*(np.concatenate([getattr(c, x) for c in counters]) for x in ("high", "low")), half, np.concatenate([c.counts for c in counters]))
