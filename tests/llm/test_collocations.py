from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from assaylake.llm import collocations, quotient_filters as Q
from assaylake.plans.scratch import new_folder


def brute_force(rows, least, most):
    """(lang, rank, phrase, a, l, r, n, score)"""
    count, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    count[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, c in count.items():
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inner = {p[i : i + m] for p, a in candidates.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * a >= 80 * c[p[i : i + m]]}
        found = []
        for p, a in candidates.items():
            if p not in inner:
                score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(found)[:most]):
            out.append((lang, i + 1, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


ODD = [
    (None, "a b a b. A B a b"),
    (None, None),
    ("en", ""),
    ("en", " \t\n"),
    ("en", "a b c d e. a b c d! a b c d\x0ba b c d\x0ca\tb"),
    ("en", "a a a a a a é é é é"),
    ("und", "a b"),
    ("fr", "a\x01 b a\x01 b a\x01 b a! b a! b a! b"),
    ("de", "x y " * 40_000),
    ("de", "z" * 100_000 + " x y"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, a, b, "s", 1, 2.0) for i, (a, b) in enumerate(rows)], "doc_id long, lang string, text string, rank string, n int, word double")


@pytest.mark.parametrize("most", [2, 2000])
@pytest.mark.parametrize("least", [1, 2, 3])
def test_equals_brute_force_on_odd_rows(spark, least, most):
    found = collocations.collocations(frame(spark, ODD), scratch=new_folder(spark, "t"), least=least, most=most)
    assert sorted(map(tuple, found.collect())) == brute_force(ODD, least, most)


def test_small_packs_and_shards(spark, monkeypatch):
    """Many packs, many shards, and words that are joined and not broadcast."""
    rows = [(lang, " ".join(f"w{(i * i + j * 7) % 23}" + "," * (j % 11 == 0) for j in range(60))) for i in range(60) for lang in ("en", "de")]
    monkeypatch.setattr(collocations, "MOST_BROADCAST", 0)
    docs = spark.createDataFrame([(a, b) for a, b in rows], "lang string, text string")
    for pack, shard in ((1 << 20, 1 << 20), (2000, 100)):
        monkeypatch.setattr(collocations, "PACK_BYTES", pack)
        monkeypatch.setattr(collocations, "SHARD_WORDS", shard)
        found = collocations.collocations(docs, scratch=new_folder(spark, "t"), least=4)
        assert sorted(map(tuple, found.collect())) == brute_force(rows, 4, 2000)


def test_an_empty_table(spark):
    found = collocations.collocations(frame(spark, ODD).where("false"), scratch=new_folder(spark, "t"))
    assert found.collect() == [] and found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_words_of_one_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(collocations.arrays, "span_hashes", lambda buf, starts, ends: np.zeros(len(starts), np.uint64))
    buf = np.frombuffer(b"ab cd ab ef ab cd", np.uint8)
    starts = np.arange(0, 18, 3)
    sample, which, count = collocations.local_words(buf, starts, starts + 2, np.zeros(6, np.int64))
    assert [bytes(buf[starts[s] : starts[s] + 2]) for s in sample] == [b"ab", b"cd", b"ef"]
    assert which.tolist() == [0, 1, 0, 2, 0, 1] and count.tolist() == [3, 2, 1]


@pytest.mark.parametrize("half", [8, 14, 32, 33, 48, 64])
def test_filters_lose_nothing(half):
    random = np.random.default_rng(half)
    mask = np.uint64((1 << half) - 1)
    high, low = (random.integers(0, 1 << 63, 3000, np.uint64) * np.uint64(3) & mask for _ in range(2))
    high[:500], low[:500] = high[0], low[0] >> np.uint64(1)
    p = Q.permute(high, low, half)
    back = Q.restore(*p, half)
    assert np.array_equal(back[0], high) and np.array_equal(back[1], low)
    truth = Counter(zip(high.tolist(), low.tolist(), strict=True))
    merged = Counter()
    for bits in (0, 3, 8):
        parts = [Q.counted(p[0][i::3], p[1][i::3], half) for i in range(3)]
        shards = {}
        for part in parts:
            for s, c in Q.split(part, half, bits):
                shards.setdefault(s, []).append(Q.load(Q.dump(c, half, bits), half, bits, s))
        merged = Counter()
        for held in shards.values():
            m = Q.merge(held, half)
            merged.update(dict(zip(zip(*(x.tolist() for x in Q.restore(m.high, m.low, half)), strict=True), m.counts.tolist(), strict=True)))
        assert merged == truth


def test_counts_over_a_byte():
    c = Q.Counter(np.array([1, 2, 3], np.uint64), np.array([5, 5, 9], np.uint64), np.array([254, 255, 1 << 40]))
    again = Q.load(Q.dump(c, 8, 2), 8, 2, 0)
    assert again.counts.tolist() == [254, 255, 1 << 40] and again.high.tolist() == [1, 2, 3]
