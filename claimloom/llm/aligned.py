"""Operator 11: the tokens of two tokenizers on one text, aligned by where they end.

A is a byte-level vocabulary of ranks, B a piece vocabulary. Both see a text with one space in front (B adds it itself), and
strings that look like special tokens are ordinary text. Each gives a list of byte offsets at which its tokens end; the
shorter list drives a galloping search (steps that double, then a binary search; all its offsets at once) into the longer one. Offsets in both lists
cut the tokens into groups; the differences between ranks of neighbouring offsets are the ranges of tokens that overlap, so
every link, a pair of token occurrences with a byte in common, is found once without comparing pairs.

A text is aligned in segments: white space that begins with a space or a line end, and what follows it. Neither tokenizer has
a token across such a border (A's pattern begins a token there, and B's vocabulary is checked when it is loaded), so the
border is a common offset and a text's alignment is its segments' alignments in a row. Segments met before are kept in a
bounded memo. A long text is read in blocks, hence the memory for it does not grow beyond its distinct id pairs.

How many documents hold an id pair linked is counted over all documents: distinct pairs of each document, summed within a
task and then by ``groupBy``. The HEAD most widespread pairs at most are sent to the workers as sorted arrays (27 MB, a bound
by construction); what is linked by any other pair is exploded and joined with the rest of the table. Those pairs are the rare
ones, so none of them is a hot key.

Defined cases: null and empty texts, and texts whose tokens don't give back their bytes (those with U+2581), have no tokens:
zeros and an empty ``groups_sha256``. Repeated rows are documents of their own, also for the counts. An empty table gives an empty
result. Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import Stored, bounded, slices

HEAD, MEMO, MEMO_LINKS, BLOCK, KEPT_PAIRS = 1 << 21, 400_000, 4_000_000, 1 << 20, 1 << 21
B_BITS = 15
SPACE = "▁"
SEGMENT = re.compile(r"(?<!\s)[ \n]\s*+\S++(?:[^\S \n]\s*+\S++)*+")
CUT = re.compile(r"\S(?=[ \n]\s*\S)")
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
COUNTED = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def gallop(ends: np.ndarray, targets: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each target the first index from its ``start`` on whose offset is the target or more, where there is one: steps
    that double until they pass it, then a binary search of the last step. All targets advance together."""
    low, last = start.copy(), len(ends) - 1
    high = low.copy()
    step = 1
    active = np.flatnonzero(ends[high] < targets)
    while len(active):
        low[active] = high[active] + 1
        high[active] = np.minimum(high[active] + step, last)
        step *= 2
        active = active[ends[high[active]] < targets[active]]
    active = np.flatnonzero(low < high)
    while len(active):
        middle = (low[active] + high[active]) // 2
        below = ends[middle] < targets[active]
        low[active[below]] = middle[below] + 1
        high[active[~below]] = middle[~below]
        active = active[low[active] < high[active]]
    return high


def overlaps(short: np.ndarray, long: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token of the list with fewer ends: the first and last token of the other that it overlaps, and whether both end
    at one offset. Both lists ascend and end at the same offset; the search for an end begins at ``start``."""
    last = gallop(long, short, start)
    hit = long[last] == short
    first = np.concatenate(([0], (last + hit)[:-1]))
    return first, last, hit


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``first, first + 1, ...`` of ``count`` numbers each, in a row."""
    return np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())


def align(a: np.ndarray, b: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links as indices of tokens of A and of B, and the groups' ends (exclusive) in A and B. ``borders`` are offsets that are
    known to be in both lists, 0 first; the search for an end starts behind the border before it."""
    turned = len(a) > len(b)
    short, long = (b, a) if turned else (a, b)
    known = gallop(long, borders[1:], np.zeros(len(borders) - 1, np.int64))
    begins = np.concatenate(([0], known + 1))
    first, last, hit = overlaps(short, long, begins[np.searchsorted(borders, short, "left") - 1])
    one, other = np.repeat(np.arange(len(short)), last - first + 1), spread(first, last - first + 1)
    ends = np.flatnonzero(hit) + 1, last[hit] + 1
    return (other, one, ends[1], ends[0]) if turned else (one, other, *ends)


class Pair:
    """Both tokenizers, with the bytes of their tokens."""

    def __init__(self, ranks: str, pattern: str, pieces: str):
        import sentencepiece
        import tiktoken

        with open(ranks, "rb") as file:
            known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.a = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.a_bytes = [b""] * (max(known.values()) + 1)
        for token, rank in known.items():
            self.a_bytes[rank] = token
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_size, self.b_size = (np.array([len(x) for x in table]) for table in (self.a_bytes, self.b_bytes))
        # ids as text with what may follow them: another id of the same tokenizer, or the other one's ids, or a new group
        self.shown = [b"%d%c" % (i, c) for table, marks in ((self.a_bytes, b",|"), (self.b_bytes, b",;")) for c in marks for i in range(len(table))]
        self.shown_size = np.array([len(x) for x in self.shown])
        # only then is white space that begins with a space or a line end a border between tokens of B
        self.cuts = not any(b" " in x.lstrip(b" ") or (b"\n" in x and len(x) > 1) for x in self.b_bytes)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(BYTE_PIECE.fullmatch(piece).group(1), 16)])
        return piece.replace(SPACE, " ").encode()

    def aligned(self, parts: list[str], show: bool = True) -> tuple[np.ndarray, list[bytes], np.ndarray] | None:
        """For the text that ``parts`` make together, which begins with a space: codes of all links, the groups of each part as text
        (if ``show``), and for each part the numbers of tokens of A and B, groups and links. None where tokens don't give back
        the bytes. Borders between parts are ends of tokens for both."""
        text = "".join(parts)
        data = text.encode()
        a = np.array(self.a.encode_ordinary(text))
        b = np.array(list(chain.from_iterable(self.b.encode([x[1:] for x in _short(parts)], num_threads=1))))
        if b"".join([self.b_bytes[i] for i in b.tolist()]) != data or b"".join([self.a_bytes[i] for i in a.tolist()]) != data:
            return None
        borders = np.fromiter(accumulate([len(p.encode()) for p in parts], initial=0), np.int64, len(parts) + 1)
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        i, j, i_ends, j_ends = align(a_ends, b_ends, borders)
        codes = (a[i] << B_BITS | b[j]).astype(np.uint32)
        # where each part ends among tokens, links and groups
        in_a, in_b = np.searchsorted(a_ends, borders[1:]) + 1, np.searchsorted(b_ends, borders[1:]) + 1
        in_links, in_groups = np.searchsorted(i, in_a), np.searchsorted(i_ends, in_a) + 1
        counts = np.diff(np.stack((in_a, in_b, in_groups, in_links), 1), axis=0, prepend=0)
        groups = [b""] * len(parts)
        if show:
            text, begins = self._groups(a, b, i_ends, j_ends)
            in_text = begins[in_a + in_b].tolist()
            groups = [text[x : y - 1] for x, y in zip([0, *in_text], in_text)]
        return codes, groups, counts

    def _groups(self, a: np.ndarray, b: np.ndarray, i_ends: np.ndarray, j_ends: np.ndarray) -> tuple[bytes, np.ndarray]:
        """All groups as text, each closed by a semicolon, and where each token's part of it begins, tokens of A before those of B in a group."""
        of_a = np.repeat(np.arange(len(i_ends)), np.diff(i_ends, prepend=0))
        of_b = np.repeat(np.arange(len(j_ends)), np.diff(j_ends, prepend=0))
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.concatenate(([0], j_ends))[of_a]] = a + len(self.a_bytes) * np.isin(np.arange(1, len(a) + 1), i_ends)
        order[np.arange(len(b)) + i_ends[of_b]] = 2 * len(self.a_bytes) + b + len(self.b_bytes) * np.isin(np.arange(1, len(b) + 1), j_ends)
        return b"".join([self.shown[k] for k in order.tolist()]), np.concatenate(([0], np.cumsum(self.shown_size[order])))

    def alone(self, part: str, show: bool = True) -> tuple[np.ndarray, list[bytes], np.ndarray] | None:
        """One part by itself; a word in front gives it the space that a text begins with."""
        return self.aligned([part], show) if part[0] == " " else _rest(self.aligned([" a", part], show))


def _short(parts: list[str], size: int = 400) -> Iterator[str]:
    """The text that ``parts`` make, in short texts that begin with a space (B is fastest on them)."""
    begin, n = 0, 0
    for k, part in enumerate(parts):
        if n > size and part[0] == " ":
            yield "".join(parts[begin:k])
            begin, n = k, 0
        n += len(part)
    yield "".join(parts[begin:])


def _rest(found: tuple[np.ndarray, list[bytes], np.ndarray] | None) -> tuple[np.ndarray, list[bytes], np.ndarray] | None:
    """Without the first part."""
    return found and (found[0][found[2][0, 3] :], found[1][1:], found[2][1:])


def segments(text: str) -> list[str]:
    """``text``, which begins with white space, in segments."""
    out = SEGMENT.findall(text)
    covered = sum(map(len, out))
    if covered < len(text):  # white space at the end
        out[-1:] = [text[covered - len(out[-1]) :] if out else text]
    return out


def blocks(text: str, size: int = BLOCK) -> Iterator[str]:
    """``text`` cut between segments into blocks of about ``size`` code points."""
    at = 0
    while len(text) - at > size:
        found = CUT.search(text, at + size)
        if not found:
            break
        yield text[at : found.end()]
        at = found.end()
    yield text[at:]


class Memo:
    """Segments met before: numbered, with their links in one array and their counts in others."""

    def __init__(self, pair: Pair, weigh=None):
        self.pair, self.weigh = pair, weigh
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.kept = np.zeros(0, np.uint32)
        self.links = np.zeros(1, np.int64)  # where each segment's links begin, and the end
        self.counts = np.zeros((0, 4), np.int64)
        self.weights = np.zeros((0, 2), np.int64)
        self.rare, self.any_rare = np.zeros(0, bool), False
        self.lossy = np.zeros(0, bool)

    def numbers(self, wanted: list[str]) -> np.ndarray:
        """The segments' numbers; new ones are aligned together."""
        if len(self.number) > MEMO or len(self.kept) > MEMO_LINKS:
            self.clear()
        out = list(map(self.number.get, wanted))
        new = dict.fromkeys(s for s, k in zip(wanted, out) if k is None)
        if new:
            # white space at a segment's end and what follows it would be one
            together = [s for s in new if not s[-1].isspace()]
            self._add(together, False)
            self._add([s for s in new if s[-1].isspace()] if len(together) < len(new) else [], True)
            out = list(map(self.number.__getitem__, wanted))
        return np.array(out, np.int64)

    def _add(self, new: list[str], alone: bool) -> None:
        if not new:
            return
        show = self.weigh is not None
        if alone or (found := _rest(self.pair.aligned([" a", *new], show))) is None:
            nothing = np.zeros(0, np.uint32), [b""], np.zeros((1, 4), np.int64)
            results = [self.pair.alone(s, show) for s in new]
            codes, groups, counts = zip(*(r or nothing for r in results))
            found = np.concatenate(codes), list(chain.from_iterable(groups)), np.concatenate(counts)
            lossy = np.array([r is None for r in results])
        else:
            lossy = np.zeros(len(new), bool)
        codes, groups, counts = found
        self.number |= zip(new, range(len(self.number), len(self.number) + len(new)))
        self.groups += groups
        ends = np.cumsum(counts[:, 3])
        if self.weigh is not None:
            weights, rare = self.weigh(codes)
            sums = np.concatenate((np.zeros((1, 2), np.int64), np.cumsum(weights, 0)))
            self.weights = np.concatenate((self.weights, sums[ends] - sums[ends - counts[:, 3]]))
            self.rare = np.concatenate((self.rare, rare))
            self.any_rare = self.any_rare or bool(rare.any())
        self.kept = np.concatenate((self.kept, codes))
        self.links = np.concatenate((self.links, self.links[-1] + ends))
        self.counts = np.concatenate((self.counts, counts))
        self.lossy = np.concatenate((self.lossy, lossy))

    def places(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the links of these segments lie in ``kept``, and how many each has."""
        size = self.links[numbers + 1] - self.links[numbers]
        return spread(self.links[numbers], size), size

    def texts(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The segments of texts in order, some at a time: their rows, their numbers, and where each row's begin; a long row
        comes in several turns. The numbers hold until the next turn."""
        rows, parts, size = [], [], 0
        for row, text in enumerate(texts):
            for block in blocks(" " + text) if text and self.pair.cuts else [" " + text] if text else ():
                rows.append(row)
                parts.append(segments(block) if self.pair.cuts else [block])
                size += len(block)
                if size > BLOCK:
                    yield self._turn(rows, parts)
                    rows, parts, size = [], [], 0
        if rows:
            yield self._turn(rows, parts)

    def _turn(self, rows: list[int], parts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        numbers = self.numbers(list(chain.from_iterable(parts)))
        begins = np.fromiter(accumulate(map(len, parts[:-1]), initial=0), np.int64, len(parts))
        return np.array(rows), numbers, begins


@lru_cache(maxsize=1)
def pair(ranks: str, pattern: str, pieces: str) -> Pair:
    """One per Python worker."""
    return Pair(ranks, pattern, pieces)


@lru_cache(maxsize=1)
def memo(run: str, ranks: str, pattern: str, pieces: str) -> Memo:
    """One per Python worker and run, so that it serves all batches of a run."""
    return Memo(pair(ranks, pattern, pieces))


class Sums:
    """Keys with counts, compacted when many have come."""

    def __init__(self, most: int = KEPT_PAIRS):
        self.most, self.waiting, self.keys, self.counts, self.size = most, [], np.zeros(0, np.uint64), np.zeros(0, np.int64), 0

    def add(self, keys: np.ndarray) -> None:
        self.waiting.append(keys.astype(np.uint64))
        self.size += len(keys)
        if self.size > self.most:
            self.compact()

    def compact(self) -> tuple[np.ndarray, np.ndarray]:
        if self.waiting:
            new = np.sort(np.concatenate(self.waiting))
            begins = np.flatnonzero(np.concatenate(([True], new[1:] != new[:-1]))) if len(new) else np.zeros(0, np.int64)
            keys, counts = new[begins], np.diff(np.append(begins, len(new)))
            if len(self.keys):
                keys, place = np.unique(np.concatenate((self.keys, keys)), return_inverse=True)
                counts = np.bincount(place, np.concatenate((self.counts, counts)), len(keys)).astype(np.int64)
            self.keys, self.counts = keys, counts
            self.waiting, self.size = [], 0
        return self.keys, self.counts


CODE = np.uint64((1 << 31) - 1)


def keyed(rows: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return rows.astype(np.uint64) << np.uint64(31) | codes.astype(np.uint64)


def counted(docs: DataFrame, ranks: str, pattern: str, pieces: str) -> DataFrame:
    """``code, n``: how many rows of ``docs`` hold an id pair linked; the code is ``a * 2^15 + b``."""
    name = uuid.uuid4().hex

    def run(batches):
        tool, total = memo(name, ranks, pattern, pieces), Sums()
        for batch in slices(batches):
            held, lossy = Sums(), np.zeros(batch.num_rows, bool)
            for rows, numbers, begins in tool.texts(batch["text"].to_pylist()):
                lossy[rows] |= np.logical_or.reduceat(tool.lossy[numbers], begins)
                once = np.unique(np.repeat(rows, np.diff(np.append(begins, len(numbers)))) << 32 | numbers)
                places, size = tool.places(once & 0xFFFFFFFF)
                held.add(keyed(np.repeat(once >> 32, size), tool.kept[places]))
            keys = held.compact()[0]
            total.add((keys & CODE)[~lossy[(keys >> np.uint64(31)).astype(np.int64)]])
            if len(total.keys) > KEPT_PAIRS:
                yield _counts(total)
                total = Sums()
        yield _counts(total)

    parts = docs.select("text").transform(bounded).mapInArrow(run, "code long, n long")
    return parts.groupBy("code").agg(F.sum("n").alias("n"))


def _counts(total: Sums) -> pa.RecordBatch:
    keys, counts = total.compact()
    return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(counts)], ["code", "n"])


def best(pairs: DataFrame) -> DataFrame:
    """``pairs`` with ``best``: no other pair with its id of A is held by more documents."""
    of_a = F.shiftright("code", B_BITS)
    tops = pairs.groupBy(of_a.alias("a")).agg(F.max("n").alias("top"))  # at most a row per id of A
    return pairs.join(F.broadcast(tops), of_a == F.col("a")).select("code", "n", (F.col("n") == F.col("top")).alias("best"))


def least(pairs: DataFrame, head: int) -> int:
    """A count such that at most ``head`` pairs have it or more; counts are taken from a scale of 16 steps an octave."""
    step = F.floor(F.log2("n") * 16).cast("int")
    room, bound = head, None
    for row in sorted(pairs.groupBy(step.alias("step")).count().collect(), reverse=True):  # at most 1,024 steps
        room -= row["count"]
        if room < 0:
            bound = row["step"]
            break
    return 0 if bound is None else math.ceil(2 ** ((bound + 1) / 16) - 1e-9)


class Head:
    """Counts of the most widespread pairs."""

    def __init__(self, codes: np.ndarray, n: np.ndarray, best: np.ndarray):
        order = np.argsort(codes)
        self.codes, self.n, self.best = codes[order].astype(np.uint32), n[order], best[order]

    def __call__(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each link whether it is its id's best and its count, 0 where the pair is not here; and where that is so."""
        if not len(self.codes):
            return np.zeros((len(codes), 2), np.int64), np.ones(len(codes), bool)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        rare = self.codes[at] != codes
        return np.where(rare[:, None], 0, np.stack((self.best[at], self.n[at]), 1)), rare


def aligned(docs: DataFrame, ranks: str, pattern: str, pieces: str, groups: bool = True, head: int = HEAD) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id``, the numbers of tokens, groups and links, ``n_best`` (links whose
    pair no other pair of its id of A exceeds in documents), ``count_sum`` (documents that hold a link's pair, summed over links),
    ``groups_sha256``, and ``groups`` if asked for. ``ranks``, ``pattern`` and ``pieces`` name files that every executor has."""
    spark = docs.sparkSession
    pairs = Stored(counted(docs, ranks, pattern, pieces), "pairs")
    tables = Stored(best(pairs.df), "pairs-best")
    bound = least(tables.df, head)
    found = tables.df.where(F.col("n") >= bound).toArrow()
    sent = spark.sparkContext.broadcast(Head(*(found[c].to_numpy() for c in ("code", "n", "best"))))
    pairs.drop()
    name = uuid.uuid4().hex
    fields = [*((c, "long") for c in COUNTED), ("groups_sha256", "string"), *[("groups", "string")] * groups]
    rare_type = "array<struct<code:long,times:long>>"

    def run(batches):
        tool = memo(name, ranks, pattern, pieces)
        tool.weigh = sent.value
        for batch in slices(batches):
            n = batch.num_rows
            sums, lossy, rare, text = np.zeros((n, 6), np.int64), np.zeros(n, bool), Sums(), [[] for _ in range(n)]
            digests = [None] * n
            for rows, numbers, begins in tool.texts(batch["text"].to_pylist()):
                lossy[rows] |= np.logical_or.reduceat(tool.lossy[numbers], begins)
                np.add.at(sums, rows, np.add.reduceat(np.hstack((tool.counts[numbers], tool.weights[numbers])), begins))
                if tool.any_rare:
                    places, size = tool.places(numbers)
                    of_row = np.repeat(np.repeat(rows, np.diff(np.append(begins, len(numbers)))), size)
                    at = tool.rare[places]
                    rare.add(keyed(of_row[at], tool.kept[places[at]]))
                ends = [*begins[1:].tolist(), len(numbers)]
                for row, i, j in zip(rows.tolist(), begins.tolist(), ends):
                    part = b";".join([tool.groups[k] for k in numbers[i:j].tolist()])
                    if digests[row] is None:
                        digests[row] = hashlib.sha256(part)
                    else:
                        digests[row].update(b";" + part)
                    if groups:
                        text[row].append(part)
            sums[lossy] = 0
            shown = [d is not None and not bad for d, bad in zip(digests, lossy.tolist())]
            keys, times = rare.compact()
            of_row = (keys >> np.uint64(31)).astype(np.int64)
            keep = ~lossy[of_row]
            offsets = np.searchsorted(of_row[keep], np.arange(n + 1)).astype(np.int32)
            links = pa.StructArray.from_arrays([pa.array((keys[keep] & CODE).astype(np.int64)), pa.array(times[keep])], ["code", "times"])
            columns = [batch["doc_id"], batch["row"], pa.ListArray.from_arrays(pa.array(offsets), links), *map(pa.array, sums.T)]
            columns.append(pa.array([d.hexdigest() if s else "" for d, s in zip(digests, shown)], pa.string()))
            if groups:
                columns.append(pa.array([b";".join(t).decode() if s else "" for t, s in zip(text, shown)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "rare", *(f[0] for f in fields)])

    schema = ", ".join(f"{c} {kind}" for c, kind in [("doc_id", "long"), ("row", "long"), ("rare", rare_type), *fields])
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("row")).transform(bounded).mapInArrow(run, schema)
    names = ["doc_id", *(f[0] for f in fields)]
    if bound == 0:  # every pair was sent
        tables.drop()
        return rows.select(*names)
    stored = Stored(rows, "aligned").df  # row numbers are fixed from here on
    links = stored.select("row", F.inline("rare")).join(tables.df, "code")
    more = links.groupBy("row").agg(F.sum(F.col("best").cast("long") * F.col("times")).alias("b"), F.sum(F.col("n") * F.col("times")).alias("c"))
    joined = stored.join(more, "row", "left")
    added = {"n_best": F.col("n_best") + F.coalesce("b", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("c", F.lit(0))}
    return joined.withColumns(added).select(*names)
