"""Operator 4: stupid-backoff scores of every document against all other documents.

The score of a word after the two before it is the first of these whose count is not zero: count(three) / count(first two);
0.4 * count(two) / count(first); 0.16 * count(one) / words; and 0.16 / words for a word that no other document has. Counts
are over all documents, less the document's own: otherwise every run of words had been seen and nothing would ever back off. A document's score is
the sum of the natural logarithms.

How it runs. (1) Documents are packed into blocks of about BLOCK_WORDS words, in the order they are read; a block's words
go to a table as numbers of its own dictionary of word hashes, bucketed by block. (2) Each block's distinct n-grams of each order, as sorted
64-bit hashes with their counts in the block, are cut by ranges of the hash: one row per block, order and range. That is the exploded
side, aggregated before it is shuffled. (3) All rows of a range meet in one task, which sums the counts: a
partition of the count table. The join gives each block the totals of its own n-grams, in its own order. (4) Blocks are joined with their totals (only these are shuffled),
scores are computed position by position and summed per document.

Ranges are of equal size as hashes are uniform, and a frequent n-gram is one entry per block, so no key is hot. The number of ranges and of blocks follows the number of
words; a task holds one range or one block. Distinct n-grams with the same 64-bit hash would share a count; with 10^9
n-grams that is expected for less than one in ten million.

Defined cases: null text counts as empty; documents without words have 0 words and no mean; repeated rows count as documents
of their own, null ids included; an empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import Stored, bounded, slices
from claimloom.llm.words import mix, word_hashes
from claimloom.operators.keyed import split_join
from claimloom.session import fresh_path

ORDER, ALPHA, BLOCK_WORDS, RANGE_KEYS = 3, 0.4, 1_500_000, 1_000_000


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers, byte plane by byte plane, compressed: upper planes are mostly zero."""
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def packed_sorted(keys: np.ndarray) -> bytes:
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


def grams(words: np.ndarray, row: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``order`` words that end at each position, and the positions that have such a run inside their document."""
    n = len(words)
    if n < order:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    end = np.arange(order - 1, n)
    inside = row[end] == row[end - order + 1]
    h = np.full(n - order + 1, order, np.uint64)
    for k in range(order):
        h = mix(h ^ words[k : k + len(h)])
    return h[inside], end[inside]


def _blocks(docs: DataFrame) -> DataFrame:
    """``block, n_words, ids, lengths, dictionary, words``: documents packed into blocks."""

    def run(batches):
        number = (TaskContext.get().partitionId() << 32) if TaskContext.get() else 0
        ids, lengths, words, held = [], [], [], 0

        def row():
            every = np.concatenate(words) if words else np.zeros(0, np.uint64)
            dictionary, place = np.unique(every, return_inverse=True)
            columns = [[number], [held], [ids], [packed(np.concatenate(lengths))], [packed_sorted(dictionary)], [packed(place)]]
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["block", "n_words", "ids", "lengths", "dictionary", "words"])

        for batch in slices(batches, 1024):
            hashes, begins = word_hashes([t or "" for t in batch["text"].to_pylist()])
            ids = ids + batch["doc_id"].to_pylist()
            lengths.append(np.diff(begins))
            words.append(hashes)
            held += len(hashes)
            if held >= BLOCK_WORDS or len(ids) >= BLOCK_WORDS // 4:
                yield row()
                number, ids, lengths, words, held = number + 1, [], [], [], 0
        if ids:
            yield row()

    return docs.select("doc_id", "text").transform(bounded).mapInArrow(run, "block long, n_words long, ids array<long>, lengths binary, dictionary binary, words binary")


def _open(lengths: bytes, dictionary: bytes, words: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a block and the document of each."""
    sizes = unpacked(lengths).astype(np.int64)
    return unpacked_sorted(dictionary)[unpacked(words).astype(np.int64)], np.repeat(np.arange(len(sizes)), sizes)


def _asked(blocks: DataFrame, ranges: int) -> DataFrame:
    """``block, part, keys, counts``: each block's distinct n-grams, cut by hash."""
    width = np.uint64(-(-(1 << 64) // ranges)) if ranges > 1 else None

    def run(batches):
        for batch in slices(batches, 1):
            block, lengths, dictionary, data = (batch[c][0].as_py() for c in ("block", "lengths", "dictionary", "words"))
            words, row = _open(lengths, dictionary, data)
            for n in range(1, ORDER + 1):
                keys, counts = np.unique(grams(words, row, n)[0], return_counts=True)
                cuts = np.searchsorted(keys, np.arange(1, ranges, dtype=np.uint64) * width) if ranges > 1 else []
                for part, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(keys)]), n * ranges):
                    if b > a:
                        yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([part], pa.int32()), pa.array([packed_sorted(keys[a:b])]), pa.array([packed(counts[a:b])])], ["block", "part", "keys", "counts"])

    return blocks.select("block", "lengths", "dictionary", "words").transform(bounded).mapInArrow(run, "block long, part int, keys binary, counts binary")


def _answered(asked: DataFrame) -> DataFrame:
    """``block, part, totals``: the totals over all blocks of each block's n-grams."""

    def answers(part: int, rows: list[tuple[int, bytes, bytes]]):
        keys = [unpacked_sorted(k) for _, k, _ in rows]
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(place, np.concatenate([unpacked(c) for _, _, c in rows])).astype(np.uint64)[place]
        for (block, _, _), own in zip(rows, np.split(totals, np.cumsum([len(k) for k in keys])[:-1])):
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([part], pa.int32()), pa.array([packed(own)])], ["block", "part", "totals"])

    def run(batches):
        part, rows = None, []
        for batch in slices(batches, 64, 16_000_000):
            for block, new, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if new != part and rows:
                    yield from answers(part, rows)
                    rows = []
                part = new
                rows.append((block, keys, counts))
        if rows:
            yield from answers(part, rows)

    return asked.repartition("part").sortWithinPartitions("part", "block").transform(bounded).mapInArrow(run, "block long, part int, totals binary")


def scored_block(words: np.ndarray, row: np.ndarray, docs: int, totals: list[np.ndarray], all_words: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sums of log scores by document, and by document how many words were scored by each order (none, one, two, three).
    ``totals`` are by order, in the order of the block's sorted n-grams."""
    n = len(words)
    rest = np.zeros((ORDER + 1, n), np.int32 if all_words < 1 << 31 else np.int64)  # counts in other documents of the run that ends here
    for k in range(1, ORDER + 1):
        h, end = grams(words, row, k)
        place = np.unique(h, return_inverse=True)[1]
        del h
        _, pair, own = np.unique(row[end] * np.int64(len(totals[k]) + 1) + place, return_inverse=True, return_counts=True)
        rest[k, end] = totals[k][place].astype(np.int64) - own[pair]
    others = np.maximum(1, all_words - np.bincount(row, minlength=docs))[row]
    level = np.where(rest[3] > 0, 3, np.where(rest[2] > 0, 2, np.where(rest[1] > 0, 1, 0))).astype(np.int8)
    score = np.log(np.where(level == 0, 1, rest[level, np.arange(n)]))
    before = np.arange(n) - 1  # the context ends one word earlier
    score -= np.log(np.where(level < 2, others, rest[np.maximum(level - 1, 0), before]) if n else score)
    score += np.log(ALPHA) * np.where(level > 1, 3 - level, 2)
    return np.bincount(row, score, docs).astype(float), [np.bincount(row, level == k, docs).astype(np.int64) for k in range(ORDER + 1)]


def scores(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_three, n_two, n_one, n_new, log_score, mean_log_score``: how many words each order scored, the sum, and the mean a word."""
    spark = docs.sparkSession
    buckets, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"backoff_{uuid.uuid4().hex}"
    _blocks(docs).write.bucketBy(buckets, "block").sortBy("block").option("path", fresh_path(spark, "blocks")).saveAsTable(name)
    blocks = spark.table(name)
    all_words = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    ranges = max(1, -(-all_words * 4 // (5 * RANGE_KEYS)))
    totals = _answered(_asked(blocks, ranges)).repartition(buckets, "block")
    by_block = totals.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("part", "totals"))).alias("answers"))
    fields = "doc_id long, n_words long, n_three long, n_two long, n_one long, n_new long, log_score double, mean_log_score double"

    def run(batches):
        for batch in slices(batches, 1):
            ids, lengths, dictionary, data, answers = (c[0].as_py() for c in batch.columns)
            words, row = _open(lengths, dictionary, data)
            own: list[list[np.ndarray]] = [[] for _ in range(ORDER + 1)]
            for a in answers or ():
                own[a["part"] // ranges].append(unpacked(a["totals"]))
            sums, levels = scored_block(words, row, len(ids), [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in own], all_words)
            n = np.bincount(row, minlength=len(ids)).astype(np.int64)
            mean = pa.array(np.round(sums / np.maximum(n, 1), 6), mask=n == 0)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *map(pa.array, (n, *levels[::-1])), pa.array(np.round(sums, 4)), mean], [f.split()[0] for f in fields.split(", ")])

    joined = blocks.join(by_block, "block", "left")
    result = joined.select("ids", "lengths", "dictionary", "words", "answers").transform(bounded).mapInArrow(run, fields)
    spark.sql(f"DROP TABLE {name}")  # the plan knows its files by now, which stay where they are
    return result


def relational(docs: DataFrame) -> DataFrame:
    """The same result in plain relational steps: each document's distinct n-grams exploded (``row, part, hash, n``), a count table by
    ``groupBy``, a join back that splits frequent n-grams over tasks, and scores per document. It shuffles a row per document and
    n-gram twice, several times the size of the texts; ``scores`` moves a fraction of that."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))

    def exploded(batches):
        for batch in slices(batches, 256):
            hashes, begins = word_hashes(batch["text"].to_pylist())
            of = np.repeat(np.arange(batch.num_rows), np.diff(begins))
            ids = batch["row"].to_numpy()
            for part in range(1, ORDER + 1):
                keys, end = grams(hashes, of, part)
                pairs = np.stack((of[end].astype(np.uint64), keys), 1)
                order = np.lexsort((pairs[:, 1], pairs[:, 0]))
                pairs = pairs[order]
                first = np.flatnonzero(np.concatenate(([True], (pairs[1:] != pairs[:-1]).any(1)))) if len(pairs) else np.zeros(0, np.int64)
                n = np.diff(np.append(first, len(pairs)))
                columns = ids[pairs[first, 0].astype(np.int64)], np.full(len(first), part, np.int8), pairs[first, 1].view(np.int64), n
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["row", "part", "hash", "n"])

    own = rows.select("row", "text").transform(bounded).mapInArrow(exploded, "row long, part tinyint, hash long, n long")
    totals = Stored(own.groupBy("part", "hash").agg(F.sum("n").alias("total"), F.count("*").alias("n")), "ngram-counts").df
    all_words = totals.where("part = 1").agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    counts = totals.where(F.col("n") > 1000).select("part", "hash", "n")
    met = split_join(own.select("row", "part", "hash"), totals.select("part", "hash", "total"), ["part", "hash"], ["row"], counts=counts)
    answers = met.groupBy("row").agg(F.collect_list(F.struct("part", "hash", "total")).alias("answers"))  # bounded by the document
    fields = "doc_id long, n_words long, n_three long, n_two long, n_one long, n_new long, log_score double, mean_log_score double"

    def run(batches):
        for batch in slices(batches, 64, 16_000_000):
            out = []
            for doc, text, found in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "answers"))):
                words = word_hashes([text])[0]
                table = np.array([(a["part"], a["hash"], a["total"]) for a in found or ()], np.int64).reshape(-1, 3)
                by_order = [np.zeros(0, np.uint64)]
                for part in range(1, ORDER + 1):
                    mine = table[table[:, 0] == part]
                    by_order.append(mine[np.argsort(np.ascontiguousarray(mine[:, 1]).view(np.uint64)), 2].astype(np.uint64))
                sums, levels = scored_block(words, np.zeros(len(words), np.int64), 1, by_order, all_words)
                mean = round(float(sums[0]) / len(words), 6) if len(words) else None
                out.append((doc, len(words), *(int(x[0]) for x in levels[::-1]), round(float(sums[0]), 4), mean))
            kinds = [pa.int64()] * 6 + [pa.float64()] * 2
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], [f.split()[0] for f in fields.split(", ")])

    return rows.join(answers, "row", "left").select("doc_id", "text", "answers").transform(bounded).mapInArrow(run, fields)
