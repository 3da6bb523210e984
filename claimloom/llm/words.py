"""Words of texts as 64-bit hashes, many texts at a time, and hashes of runs of words.

A word is a longest run of letters, digits and combining marks, lower-cased letter by letter. Everything else separates.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np

PIECE = 1 << 19
#: The increment and the two multipliers of the published splitmix64 generator.
STEP, FIRST, SECOND = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
BASE = 0xD6E8FEB86659FD93  # an odd number, so that it has an inverse modulo 2^64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x + np.uint64(STEP)
    x ^= x >> np.uint64(30)
    x *= np.uint64(FIRST)
    x ^= x >> np.uint64(27)
    x *= np.uint64(SECOND)
    x ^= x >> np.uint64(31)
    return x


@cache
def _values() -> np.ndarray:
    """By code point: 0 outside words, else a 64-bit number of its lower-case letter."""
    low = np.zeros(0x34000, np.uint64)
    for c in range(len(low)):
        if unicodedata.category(chr(c))[0] in "LNM":
            low[c] = ord(chr(c).lower()[0])
    out = mix(low)
    out[low == 0] = 0
    return out


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    up = np.cumprod(np.full(PIECE + 1, BASE, np.uint64), dtype=np.uint64)
    down = np.cumprod(np.full(PIECE + 1, pow(BASE, -1, 1 << 64), np.uint64), dtype=np.uint64)
    return up, down


def is_word_char(c: str) -> bool:
    return ord(c) < 0x34000 and unicodedata.category(c)[0] in "LNM"


def _group_hashes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of one piece of text, and the code point at which each word begins."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    table = _values()
    value = table[np.minimum(points, len(table) - 1)]
    inside = np.concatenate(([False], value != 0, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edges[::2], edges[1::2]
    up, down = _powers()
    if len(points) > PIECE:  # one run without any break
        up = np.cumprod(np.full(len(points), BASE, np.uint64), dtype=np.uint64)
        down = np.cumprod(np.full(len(points), pow(BASE, -1, 1 << 64), np.uint64), dtype=np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value * up[: len(points)], dtype=np.uint64)))
    return mix((sums[end] - sums[begin]) * down[begin]), begin


def _cuts(texts: list[str]) -> list[tuple[list[int], list[str]]]:
    """Texts put together, or cut between words, into pieces of about PIECE code points: for each piece the rows and their parts."""
    rows: list[int] = []
    parts: list[str] = []
    size, out = 0, []
    for row, text in enumerate(texts):
        at = 0
        while True:
            end = min(len(text), at + PIECE - 1)
            while end < len(text) and is_word_char(text[end]) and is_word_char(text[end - 1]):
                end -= 1
                if end <= at:  # a word longer than a piece stays whole
                    end = at + PIECE
                    while end < len(text) and is_word_char(text[end]):
                        end += 1
                    break
            if parts and size + end - at + 1 > PIECE:
                out.append((rows, parts))
                rows, parts, size = [], [], 0
            rows.append(row)
            parts.append(text[at:end])
            size += end - at + 1
            at = end
            if at >= len(text):
                break
    if parts:
        out.append((rows, parts))
    return out


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text (and the end) the index of its first word."""
    found, counts = [], np.zeros(len(texts) + 1, np.int64)
    for rows, parts in _cuts(texts):
        hashes, begin = _group_hashes("\n".join(parts))
        offsets = np.concatenate(([0], np.cumsum([len(p) + 1 for p in parts])))
        at = np.searchsorted(begin, offsets)
        np.add.at(counts, np.asarray(rows) + 1, np.diff(at))
        found.append(hashes)
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), np.cumsum(counts)


def runs(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every ``n`` words in a row: element ``i`` is for words ``i`` to ``i + n - 1``. They depend on the order."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = mix(out ^ words[k : k + len(out)])
    return out


def shingles(texts: list[str], n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``n`` words of each text with the text's row; a text of fewer words has one run of all its words, a text without words none."""
    words, begins = word_hashes(texts)
    lengths = np.diff(begins)
    hashes = runs(words, n)
    row = np.repeat(np.arange(len(texts)), lengths)
    inside = np.arange(len(words)) + n <= begins[row + 1] if len(words) else np.zeros(0, bool)
    full = hashes[inside[: len(hashes)]]
    short = np.flatnonzero((lengths > 0) & (lengths < n))
    extra = np.zeros(len(short), np.uint64)
    for k, r in enumerate(short):
        one = np.uint64(lengths[r])
        h = np.array([one], np.uint64)
        for w in words[begins[r] : begins[r + 1]]:
            h = mix(h ^ w)
        extra[k] = h[0]
    return np.concatenate((full, extra)), np.concatenate((row[inside], short))
