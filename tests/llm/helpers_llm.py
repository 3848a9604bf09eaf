"""Plain versions of the operators, for texts small enough to compare everything with everything."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import public_tokenizers

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text, k):
    w = words(lower(text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(rows, k, percent):
    """{id: smallest id reachable} over pairs of similar sets."""
    sets, least = {i: shingle_set(t, k) for i, t in rows}, {i: i for i, _ in rows}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    holders = defaultdict(list)
    for i, s in sets.items():
        shared = Counter(j for x in s for j in holders[x])
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                least[b] = a
        for x in s:
            holders[x].append(i)
    return {i: root(i) for i in sets}


def statistics(text):
    text, w = text or "", words(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    twice = Counter(windows)
    covered = {j for i, x in enumerate(windows) if twice[x] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def leaked(text, items, n=10):
    """(words, hit words, items) of a text."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    w, hit, held = split(text), set(), set()
    for item, content in items:
        i = split(content)
        for window in {tuple(i[p : p + n]) for p in range(max(1, len(i) - n + 1))} if i else ():
            for p in range(len(w) - len(window) + 1):
                if tuple(w[p : p + len(window)]) == window:
                    hit.update(range(p, p + len(window)))
                    held.add("" if item is None else str(item))
    return len(w), len(hit), sorted(held)


def removed(rows, length, split):
    """[(id, units, kept units)]: without units of windows that also start in a document with a smaller id."""
    big = 1 << 63
    units = [(i, split(t)) for i, t in rows]
    least = {}
    for i, u in units:
        for p in range(len(u) - length + 1):
            key = tuple(u[p : p + length])
            least[key] = min(least.get(key, big), big - 1 if i is None else i)
    out = []
    for i, u in units:
        gone = set()
        for p in range(len(u) - length + 1):
            if least[tuple(u[p : p + length])] < (big - 1 if i is None else i):
                gone.update(range(p, p + length))
        out.append((i, len(u), [x for p, x in enumerate(u) if p not in gone]))
    return out
