"""Plain, slow versions of what the operators compute, for small tables."""

from __future__ import annotations

import unicodedata
from collections import Counter


def plain_words(text: str | None) -> list[str]:
    out, word = [], ""
    for c in text or "":
        if unicodedata.category(c)[0] in "LNM" and ord(c) < 0x34000:
            word += c.lower()[0]
        elif word:
            out.append(word)
            word = ""
    return [*out, word] if word else out


def plain_shingles(text: str | None, n: int = 5) -> Counter:
    words = plain_words(text)
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def plain_jaccard(a: Counter, b: Counter) -> float:
    keys = a.keys() | b.keys()
    return sum(min(a[k], b[k]) for k in keys) / max(1, sum(max(a[k], b[k]) for k in keys))


def plain_components(ids, links) -> dict:
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in root}


def plain_classes(docs: list[tuple[int, str | None]], similarity: float = 0.8) -> dict[int, int]:
    """By document: the smallest id of its class."""
    sets = [(i, plain_shingles(t)) for i, t in docs if i is not None]
    by_shingle: dict = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            by_shingle.setdefault(x, []).append(k)
    pairs = {(a, b) for group in by_shingle.values() for a in group for b in group if a < b}
    links = [(sets[a][0], sets[b][0]) for a, b in pairs if plain_jaccard(sets[a][1], sets[b][1]) >= similarity]
    return plain_components([i for i, _ in sets], links)
