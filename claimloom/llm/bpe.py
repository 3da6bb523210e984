"""Operator 10: byte-level BPE encoding by a streaming transducer with bounded lookahead, and decoding by a
byte-to-text state machine.

How the transducer works. Every prefix of a byte string has exactly one encoding, and the encoding of a prefix is the
encoding of a shorter prefix plus one last token: the token ``t`` for which the merges leave ``(last token before t, t)``
apart. So the encodings of all prefixes form a tree, and one new byte adds one node to it. A later token can only start at
a position from which the bytes read so far are the beginning of some token, at most ``lookahead`` bytes back, where
``lookahead`` is the length of the longest token the merge list makes, less one. What all these live positions have in
common in the tree can't change any more and is emitted; what is kept is the last emitted token and the bytes after it.
States are made when they are first met and kept up to a bound, so a known transition is one look-up per byte.

Words (pieces of the tokenizer's own pattern) are encoded one by one, with a bounded memo of short words in front of the
transducer. The transducer's memory does not grow with the text or with the number of documents; a row's text and its ids are held
whole while it is worked on.

Null text counts as empty; empty text gives no tokens and the digests of nothing. Repeated rows give repeated rows. Only
``doc_id`` and ``text`` are read, so other columns cannot clash. A row's result depends on its text alone.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from claimloom.llm.common import bounded, slices

MEMO_WORDS, MEMO_LENGTH, STATES, PASSING, SETTLE, NEVER = 250_000, 32, 30_000, 200_000_000, 64, 1 << 60
#: Code points with the Unicode property White_Space, as character ranges of a pattern.
SPACE = "\t-\r \x85\xa0  -     　"
#: Fixed value: how the vocabulary's pre-tokenizer splits text.
GENERAL = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
LATIN = 0x250


def _latin_pattern() -> tuple[re.Pattern, re.Pattern]:
    """The same pattern for texts whose code points are all below LATIN, where the standard module is faster; and what finds other texts."""
    kind = {c: unicodedata.category(chr(c))[0] for c in range(LATIN)}
    letters, numbers = ("".join(chr(c) for c, k in kind.items() if k == x) for x in "LN")
    space = "\t-\r \x85\xa0"
    return (
        re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{letters}]+| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+"),
        re.compile(f"[^\x00-{chr(LATIN - 1)}]"),
    )


FAST, BEYOND = _latin_pattern()


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file: printable bytes stand for themselves, the
    others get the code points from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """A merge list: token bytes by id, ids by bytes, and what plain merging makes of a few bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.ids = {raw(token): i for token, i in spec["model"]["vocab"].items()}
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens") or []}
        self.bytes: dict[int, bytes] = {i: b for b, i in self.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.rank = {(raw(x), raw(y)): k for k, (x, y) in enumerate(pairs)}
        every = self.ids
        self.ids = {token: i for token, i in every.items() if len(self.merged(token)) == 1}  # merging never makes the others
        self.lookahead = max(map(len, self.ids)) - 1
        #: Beginnings of longer tokens: from such bytes on, a token may still be open.
        self.beginnings = {b[:k] for b in self.ids for k in range(1, len(b))}
        #: By token: the place in the list of the merge that made it (-1: a byte), its two parts; by pair: its merge's place.
        self.made = dict.fromkeys(self.bytes, -1)
        self.parts: dict[int, tuple[int, int]] = {}
        self.joined: dict[int, int] = {}
        for (x, y), k in self.rank.items():
            pair, token = (every[x], every[y]), every[x + y]
            self.joined[pair[0] << 32 | pair[1]] = k
            if token not in self.parts:
                self.made[token], self.parts[token] = k, pair

    def merged(self, data: bytes) -> list[bytes]:
        """Plain merging: the merge that comes first in the list is made wherever it fits, from the left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(zip(parts, parts[1:]), key=lambda p: self.rank.get(p, NEVER))
            if best not in self.rank:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def apart(self, left: int, right: int) -> bool:
        """Whether two neighbouring tokens stay as they are when their bytes are merged together.

        The merges that made the two are taken back, the latest first. They stay apart unless, at some point on the way
        down, the two parts at the border would have been merged with each other before the merge just taken back.
        Equal merges are made from the left, so one across the border comes before an equal one on its right only.
        """
        first = NEVER
        while True:
            across = self.joined.get(left << 32 | right)
            if across is not None and across < first:
                return False
            if self.made[left] > self.made[right]:
                first, left = self.made[left], self.parts[left][1]
            elif right in self.parts:
                first, right = self.made[right] + 1, self.parts[right][0]
            else:
                return True


class Transducer:
    """The lazily built transducer over the bytes of one word.

    A state holds the last emitted token (None at the start of a word), the bytes after it, the live positions in them,
    and for every position that a live one descends from, the last token that ends there and where that token starts.
    """

    def __init__(self, merges: Merges):
        self.m = merges
        self.code = {token: token.to_bytes(4, "little") for token in merges.bytes}
        self.reset()

    def reset(self) -> None:
        self.states: list[tuple] = []
        self.known: dict[tuple, int] = {}
        self.rest: list[bytes] = []
        self.next: dict[int, tuple[int, bytes]] = {}
        self.passing = 0
        self._number((None, b"", (0,), (None,), (0,)))

    def _number(self, state: tuple) -> int:
        key = state[:2]
        if key not in self.known:
            self.known[key] = len(self.states)
            self.states.append(state)
            self.rest.append(self._codes(state[3], state[4], len(state[1])))
        return self.known[key]

    def _codes(self, tokens: tuple, starts: tuple, end: int) -> bytes:
        out = []
        while end > 0:
            out.append(self.code[tokens[end]])
            end = starts[end]
        return b"".join(out[::-1])

    def _step(self, state: tuple, byte: int) -> tuple[tuple, bytes]:
        last, data, live, tokens, starts = state
        m, data = self.m, data + bytes((byte,))
        end = len(data)
        for start in live:
            token = m.ids.get(data[start:])
            if token is not None:
                before = tokens[start] if start else last
                if before is None or m.apart(before, token):
                    break
        else:
            raise ValueError("the vocabulary has no token for a byte")
        tokens, starts = (*tokens, token), (*starts, start)
        live = (*(k for k in live if data[k:] in m.beginnings), end)
        path = set(live)
        while len(path) > 1:  # up to the common ancestor of the live positions
            top = max(path)
            path.remove(top)
            path.add(starts[top])
        (root,) = path
        if not root:
            return (last, data, live, tokens, starts), b""
        done, last = self._codes(tokens, starts, root), tokens[root]
        return (last, data[root:], tuple(k - root for k in live), tokens[root:], (0, *(k - root for k in starts[root + 1 :]))), done

    def encode(self, data: bytes) -> bytes:
        """Token ids of one word as little-endian unsigned 32-bit integers."""
        number, out, known = 0, [], self.next
        for at, byte in enumerate(data):
            key = number << 8 | byte
            move = known.get(key)
            if move is None:
                if len(self.states) >= STATES:
                    return b"".join([*out, self._passing(self.states[number], data[at:])])
                after, done = self._step(self.states[number], byte)
                move = known[key] = self._number(after), done
            number, done = move
            if done:
                out.append(done)
        out.append(self.rest[number])
        return b"".join(out)

    def _passing(self, state: tuple, data: bytes) -> bytes:
        """The rest of a word from a state on when no more states are kept: the same steps in place, settled tokens emitted every
        SETTLE bytes. After many such bytes the kept states are made anew, as other words have become frequent."""
        m, ids, beginnings, out = self.m, self.m.ids, self.m.beginnings, []
        last, rest, live, tokens, starts = state[0], state[1], list(state[2]), list(state[3]), list(state[4])
        whole, at = rest + data, len(rest)
        low = 0
        for end in range(at + 1, len(whole) + 1):
            for start in live:
                token = ids.get(whole[low + start : end])
                if token is not None:
                    before = tokens[start] if start else last
                    if before is None or m.apart(before, token):
                        break
            else:
                raise ValueError("the vocabulary has no token for a byte")
            tokens.append(token)
            starts.append(start)
            live = [k for k in live if whole[low + k : end] in beginnings]
            live.append(end - low)
            if end - low >= SETTLE:
                path = set(live)
                while len(path) > 1:
                    top = max(path)
                    path.remove(top)
                    path.add(starts[top])
                (root,) = path
                if root:
                    out.append(self._codes(tokens, starts, root))
                    last, low = tokens[root], low + root
                    live, tokens, starts = [k - root for k in live], tokens[root:], [0, *(k - root for k in starts[root + 1 :])]
        out.append(self._codes(tokens, starts, len(whole) - low))
        self.passing += len(data)
        if self.passing > PASSING:
            self.reset()
        return b"".join(out)


class _Memo(dict):
    """Words met before, in two generations of at most MEMO_WORDS each."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer, self.older = transducer, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.transducer.encode(word.encode())
        if len(word) <= MEMO_LENGTH:
            if len(self) >= MEMO_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Codec:
    """Encodes and decodes whole texts."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.memo = _Memo(Transducer(self.merges))
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.merges.special, key=len, reverse=True))) or r"(?!)")
        self.token_bytes = [self.merges.bytes.get(i, b"") for i in range(max(self.merges.bytes) + 1)]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not any(s in text for s in self.merges.special):
            return self._words(text)
        out, at = [], 0
        for found in self.special.finditer(text):
            out += self._words(text[at : found.start()]), self.merges.special[found.group()].to_bytes(4, "little")
            at = found.end()
        return b"".join([*out, self._words(text[at:])])

    def _words(self, text: str) -> bytes:
        pattern = GENERAL if BEYOND.search(text) else FAST
        if len(text) <= 1 << 20:
            return b"".join(map(self.memo.__getitem__, pattern.findall(text)))
        return b"".join(self.memo[found.group()] for found in pattern.finditer(text))

    def decode(self, ids: bytes, block: int = 1 << 16) -> Iterator[str]:
        """Text in pieces. The state between pieces is the beginning of a character that is not complete yet."""
        table, pending = self.token_bytes, b""
        for at in range(0, len(ids), 4 * block):
            data = pending + b"".join([table[i] for i in np.frombuffer(ids[at : at + 4 * block], "<u4").tolist()])
            cut = complete(data)
            yield data[:cut].decode("utf-8", "replace")
            pending = data[cut:]
        if pending:
            yield pending.decode("utf-8", "replace")


def complete(data: bytes) -> int:
    """How many leading bytes can be turned into text now: all but a last character that later bytes may complete."""
    for back in range(1, min(3, len(data)) + 1):
        lead = data[-back]
        if lead >= 0xC0:
            need = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            return len(data) - back if back < need else len(data)
        if lead < 0x80:
            break
    return len(data)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One per Python worker, so that the memo serves all its batches."""
    return Codec(path)


def encoded(docs: DataFrame, path: str, ids: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids, ids_sha256, decoded_sha256`` of every row of ``docs(doc_id, text)``; without ``ids`` only
    the digests. ``path`` names a byte-level vocabulary file that every executor has."""
    fields = [("doc_id", T.LongType()), ("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    schema = T.StructType([T.StructField(*f) for f in fields] + [T.StructField("ids", T.BinaryType())] * ids)

    def run(batches):
        tool = codec(path)
        for batch in slices(batches):
            out: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                data = tool.encode(text or "")
                digest = hashlib.sha256()
                for piece in tool.decode(data):
                    digest.update(piece.encode())
                for column, value in zip(out, (doc, len(data) // 4, hashlib.sha256(data).hexdigest(), digest.hexdigest(), data if ids else None)):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
            names = [*(f[0] for f in fields), "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)][: 4 + ids], names[: 4 + ids])

    return docs.select("doc_id", "text").transform(bounded).mapInArrow(run, schema)
