"""Operator 9: token ids packed into rows of fixed length by best-fit-decreasing.

Documents are tokenized and end with the end-of-text id. A document longer than a row is split into pieces of a full row
and one last piece; nothing is cut off. Pieces are packed in blocks of about BLOCK_TOKENS tokens, in the order the documents are
read: the longest piece first, each into the open row with the least room that still takes it, else into a new one. Open rows are
found by a segment tree over the amounts of room: its leaves count the rows with so much room, and a search goes down to the
first leaf at or above a piece's length that has one.

A result row is a row of the packed matrix: ``ids`` (little-endian unsigned, 16 bits where the vocabulary allows, padded
with the end-of-text id), ``cu_seqlens`` (0 and the running ends of its segments), ``resets`` (where positions begin at 0
again), and ``segments`` (document, piece, first token within the document, length). ``unpacked`` puts the documents
together again. ``matrices`` joins rows of a partition to binary matrices, and ``write`` stores them.

Defined cases: null and empty texts are one piece with the end-of-text id only; equal lengths are packed in the order read;
repeated rows and null ids are documents of their own; an empty table gives an empty result. ``row_id`` is unique within a
result. Tasks pack what they read, so a lost task packs the same rows anew. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from claimloom.llm.bpe import BEYOND, FAST, GENERAL
from claimloom.llm.common import bounded, slices

LENGTH, BLOCK_TOKENS, MEMO_WORDS, MEMO_LENGTH = 2048, 2_000_000, 400_000, 32
SEGMENT = "struct<doc_id:long,piece:int,start:long,length:int>"
FIELDS = f"row_id long, n_tokens int, cu_seqlens array<int>, resets array<int>, segments array<{SEGMENT}>, ids binary"


class Room:
    """Segment tree over amounts of room 0 to ``most``: how many open rows have each."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, row: int, room: int) -> None:
        self.rows[room].append(row)
        self._change(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """A row with the least room of ``length`` or more, and its room; it is no longer open."""
        k = length + self.leaves
        if not self.count[k]:
            while k > 1 and (k & 1 or not self.count[k + 1]):  # up until a right neighbour holds a row
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.leaves:  # and down to its first leaf that does
                k = 2 * k + (not self.count[2 * k])
        room = k - self.leaves
        self._change(room, -1)
        return self.rows[room].pop(), room

    def _change(self, room: int, by: int) -> None:
        k = room + self.leaves
        while k:
            self.count[k] += by
            k >>= 1


def best_fit(lengths: np.ndarray, most: int) -> list[list[int]]:
    """For each row the pieces in it, in the order they were put there."""
    room, rows = Room(most), []
    for k in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[k])
        found = room.take(n)
        if found is None:
            rows.append([k])
            room.put(len(rows) - 1, most - n)
        else:
            rows[found[0]].append(k)
            room.put(found[0], found[1] - n)
    return rows


class Words(dict):
    """Ids of words met before, of at most MEMO_WORDS; others are encoded by the tokenizer library."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.tool = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1
        self.kind = np.dtype("<u2" if self.end < 1 << 16 else "<u4")

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.tool.encode_ordinary(word), self.kind).tobytes()
        if len(word) <= MEMO_LENGTH:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def document(self, text: str) -> np.ndarray:
        pattern = GENERAL if BEYOND.search(text) else FAST
        data = b"".join(map(self.__getitem__, pattern.findall(text)))
        return np.append(np.frombuffer(data, self.kind), self.kind.type(self.end))


@lru_cache(maxsize=2)
def words_of(path: str, pattern: str) -> Words:
    return Words(path, pattern)


def packed(docs: DataFrame, path: str, pattern: str, length: int = LENGTH) -> DataFrame:
    """Packed rows of all documents. ``path`` names a rank file that every executor has, ``pattern`` how its tokenizer splits text."""

    def run(batches):
        tool = words_of(path, pattern)
        number = (TaskContext.get().partitionId() << 33) if TaskContext.get() else 0
        pieces: list[tuple[int | None, int, int, np.ndarray]] = []
        held = 0

        def block():
            for pack in best_fit(np.array([len(p[3]) for p in pieces]), length):
                yield [pieces[k] for k in pack]

        def rows(first: int) -> Iterator[pa.RecordBatch]:
            out: list[list] = [[] for _ in range(6)]
            for k, pack in enumerate(block()):
                ends = np.cumsum([0, *(len(p[3]) for p in pack)])
                ids = np.full(length, tool.end, tool.kind)
                ids[: ends[-1]] = np.concatenate([p[3] for p in pack])
                segments = [{"doc_id": d, "piece": n, "start": s, "length": len(x)} for d, n, s, x in pack]
                for column, value in zip(out, (first + k, int(ends[-1]), ends.astype(np.int32), ends[:-1].astype(np.int32), segments, ids.tobytes())):
                    column.append(value)
            segment = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32())])
            kinds = (pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(segment), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["row_id", "n_tokens", "cu_seqlens", "resets", "segments", "ids"])

        for batch in slices(batches):
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids = tool.document(text or "")
                pieces += [(doc, n, s, ids[s : s + length]) for n, s in enumerate(range(0, len(ids), length))]
                held += len(ids)
            if held >= BLOCK_TOKENS:
                yield from rows(number)
                number, pieces, held = number + len(pieces), [], 0
        if pieces:
            yield from rows(number)

    return docs.select("doc_id", "text").transform(bounded).mapInArrow(run, FIELDS)


def unpacked(rows: list[dict], kind: str = "<u2") -> dict[int, np.ndarray]:
    """By document its token ids, from packed rows."""
    parts: dict[int, list[tuple[int, np.ndarray]]] = {}
    for row in rows:
        ids = np.frombuffer(row["ids"], kind)
        for begin, s in zip(row["cu_seqlens"], row["segments"]):
            parts.setdefault(s["doc_id"], []).append((s["start"], ids[begin : begin + s["length"]]))
    return {doc: np.concatenate([x for _, x in sorted(p, key=lambda p: p[0])]) for doc, p in parts.items()}


def matrices(rows: DataFrame, width: int = 2, most: int = 512) -> DataFrame:
    """``first_row_id, n_rows, ids, cu_seqlens, cu_begin, resets``: up to ``most`` packed rows as one matrix of ids, with all running ends one after another (32 bits)
    and where each row's begin, and a bit per token that says where positions begin at 0 again. ``width``: bytes of an id."""

    def run(batches):
        for batch in slices(batches, most, 1 << 26):
            ends = [np.array(c, "<i4") for c in batch["cu_seqlens"].to_pylist()]
            begin = np.cumsum([0, *map(len, ends)]).astype("<i4")
            ids = batch["ids"].to_pylist()
            flags = []
            for resets, row in zip(batch["resets"].to_pylist(), ids):
                flag = np.zeros(len(row) // width, bool)
                flag[resets] = True
                flags.append(np.packbits(flag).tobytes())
            values = [[batch["row_id"][0].as_py()], [batch.num_rows], [b"".join(ids)], [np.concatenate(ends).tobytes()], [begin.tobytes()], [b"".join(flags)]]
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["first_row_id", "n_rows", "ids", "cu_seqlens", "cu_begin", "resets"])

    return rows.transform(bounded).mapInArrow(run, "first_row_id long, n_rows int, ids binary, cu_seqlens binary, cu_begin binary, resets binary")


def write(rows: DataFrame, folder: str) -> None:
    """Matrices as Parquet files in a folder that all executors reach."""
    matrices(rows).write.parquet(folder)
