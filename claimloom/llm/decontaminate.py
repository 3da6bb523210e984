"""Operator 7: benchmark decontamination by a BM25 index of the test items and block-max WAND.

Every test item is a document of the index; a query is a passage of a training text: twice ``h`` words, a new one every ``h``
words, where ``h`` is no less than the longest item of its length class, so that an item copied into a text lies whole in one
passage. The score is BM25 over the passage's distinct words, divided by the item's score for its own words; the threshold
is a share of that. All items at or above it are retrieved: the sum of the words' highest impacts bounds a passage, the sum
of their highest impacts in a block of items bounds a block, and postings are read only for blocks that both bounds leave
open. Retrieved pairs are verified on the passage: runs of five words of the question, and words of the answer.

An item's answer is its last sentence, the rest its question; an item of one sentence is all question. A run shorter than
five words is one run of all its words.

The index is built in chunks of at most CHUNK_BYTES of item text, so that what is broadcast is bounded; statistics
(document frequencies, average length) are of all items. For every chunk the texts are read once.

Defined cases: items and texts that are null or have no words match nothing; repeated items each match; repeated rows give
repeated results; empty tables give an empty result. Of the texts only ``doc_id`` and ``text`` are read, of the items
``item_id`` and ``text``; other columns pass through ``without_leaks`` unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import bounded, slices
from claimloom.llm.words import runs, word_hashes

K1, B, THRESHOLD, OVERLAP, WORDS = 1.2, 0.75, 0.6, 0.8, 5
CHUNK_BYTES, BLOCK, LEAST_WINDOW, CELLS = 16_000_000, 4, 64, 1 << 20
SENTENCE = re.compile(r"(?<=[.!?])\s+(?=\S)")


def halves(text: str) -> tuple[str, str]:
    """Question and answer of an item."""
    parts = SENTENCE.split(text.strip())
    parts = [p for p in parts if len(word_hashes([p])[0])]
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, "")


def word_runs(words: np.ndarray) -> np.ndarray:
    return runs(words, min(WORDS, max(1, len(words))))


class Index:
    """BM25 postings of items of one length class; impacts are shares of an item's score for itself."""

    def __init__(self, ids: list[int], texts: list[str], words: list[np.ndarray], frequency: dict[int, int], items: int, mean: float):
        # items with the same most common word lie together, so that a block holds items of one language or kind
        order = sorted(range(len(ids)), key=lambda k: (max((frequency[x], x) for x in words[k].tolist()), ids[k]))
        ids, texts, words = ([x[k] for k in order] for x in (ids, texts, words))
        self.ids = ids
        self.half = max(LEAST_WINDOW, max(map(len, words)))
        own = [np.unique(w, return_counts=True) for w in words]
        term, item, impact = [], [], []
        for k, (w, (distinct, tf)) in enumerate(zip(words, own)):
            df = np.array([frequency[int(x)] for x in distinct], float)
            weight = np.log(1 + (items - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / mean))
            term.append(distinct)
            item.append(np.full(len(distinct), k))
            impact.append(weight / weight.sum())
        term, item, impact = map(np.concatenate, (term, item, impact))
        order = np.lexsort((item, term))
        term, self.item, self.impact = term[order], item[order], impact[order]
        self.terms, begin = np.unique(term, return_index=True)
        self.begin = np.append(begin, len(term))
        self.most = np.maximum.reduceat(self.impact, begin)
        # blocks: for each term the blocks it occurs in, their highest impact, and their postings
        number = np.repeat(np.arange(len(self.terms)), np.diff(self.begin))
        new = np.flatnonzero(np.append(True, (number[1:] != number[:-1]) | (self.item[1:] // BLOCK != self.item[:-1] // BLOCK)))
        self.block, self.block_most, self.block_at = self.item[new] // BLOCK, np.maximum.reduceat(self.impact, new), np.append(new, len(self.item))
        self.block_begin = np.searchsorted(number[new], np.arange(len(self.terms) + 1))
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.terms >> np.uint64(44)).astype(np.int64)] = True
        self.parts = []
        for text in texts:
            question, answer = (word_hashes([t])[0] for t in halves(text))
            self.parts.append((min(WORDS, max(1, len(question))), np.unique(word_runs(question)), np.unique(answer)))

    def numbers(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of words of the index, and their terms."""
        at = np.flatnonzero(self.maybe[(words >> np.uint64(44)).astype(np.int64)])
        term = np.minimum(np.searchsorted(self.terms, words[at]), len(self.terms) - 1)
        same = self.terms[term] == words[at]
        return at[same], term[same]

    def retrieve(self, window: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows, items that reach the threshold there, and their scores. ``window`` is ordered, ``terms`` are its distinct terms."""
        if not len(window):
            return window, window, np.zeros(0)
        blocks = int(self.block.max()) + 1
        group, number = np.cumsum(np.append(False, window[1:] != window[:-1])), window[np.append(True, window[1:] != window[:-1])]
        most = max(1, CELLS // blocks)
        out = []
        for low in range(0, len(number), most):
            a, b = np.searchsorted(group, (low, low + most))
            own, t = group[a:b] - low, terms[a:b]
            spans = _ranges(self.block_begin[t], self.block_begin[t + 1])
            own = np.repeat(own, self.block_begin[t + 1] - self.block_begin[t])
            cell = own * blocks + self.block[spans]
            open_ = np.bincount(cell, self.block_most[spans])[cell] >= THRESHOLD - 1e-9
            spans, own = spans[open_], own[open_]
            posts = _ranges(self.block_at[spans], self.block_at[spans + 1])
            own = np.repeat(own, self.block_at[spans + 1] - self.block_at[spans])
            pair, at = np.unique(own * len(self.ids) + self.item[posts], return_inverse=True)
            score = np.bincount(at, self.impact[posts], len(pair))
            found = score >= THRESHOLD - 1e-9
            out.append((number[pair[found] // len(self.ids) + low], pair[found] % len(self.ids), score[found]))
        return tuple(map(np.concatenate, zip(*out)))

    def hits(self, words: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, int, float, float, float]]:
        """``text, item id, score, question overlap, answer overlap`` for verified pairs of all passages."""
        at, term = self.numbers(words)
        if not len(at):
            return
        text = np.searchsorted(begins, at, "right") - 1
        place = at - begins[text]
        windows = np.concatenate(([0], np.cumsum(-(-np.diff(begins) // self.half))))
        order = np.lexsort((at, term, text))
        before = np.full(len(at), -1)
        same = (text[order[1:]] == text[order[:-1]]) & (term[order[1:]] == term[order[:-1]])
        before[order[1:][same]] = place[order[:-1][same]]
        k = place // self.half
        first, second = before < k * self.half, (k > 0) & (before < (k - 1) * self.half)
        window = np.concatenate((windows[text][first] + k[first], windows[text][second] + k[second] - 1))
        terms = np.concatenate((term[first], term[second]))
        bound = np.bincount(window, self.most[terms], windows[-1])
        open_ = bound[window] >= THRESHOLD - 1e-9
        order = np.lexsort((terms[open_], window[open_]))
        for w, k, score in zip(*self.retrieve(window[open_][order], terms[open_][order])):
            row = int(np.searchsorted(windows, w, "right") - 1)
            begin = begins[row] + (w - windows[row]) * self.half
            passage = words[begin : min(begin + 2 * self.half, begins[row + 1])]
            n, question, answer = self.parts[k]
            asked = _share(question, runs(passage, n))
            said = _share(answer, passage) if len(answer) else 1.0
            if asked >= OVERLAP and said >= OVERLAP:
                yield row, self.ids[k], float(score), asked, said


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges, one after another."""
    size = end - begin
    if not size.sum():
        return np.zeros(0, np.int64)
    return np.repeat(begin - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())


def _share(part: np.ndarray, whole: np.ndarray) -> float:
    """How much of ``part`` is in ``whole``."""
    return float(np.isin(part, whole).mean()) if len(part) else 0.0


def _numbered(items: DataFrame) -> tuple[DataFrame, int]:
    """The items with the number of their chunk, and how many chunks there are."""
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunks = max(1, -(-int(total) // CHUNK_BYTES))
    return items.withColumn("chunk", F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks))), chunks


def indexes(items: DataFrame) -> Iterator[list[Index]]:
    """For each chunk of items its indexes, one per length class (powers of two)."""
    items = items.select("item_id", "text").where("text is not null and item_id is not null")

    def run(batches):
        for batch in slices(batches):
            words, begins = word_hashes(batch["text"].to_pylist())
            distinct = [np.unique(words[a:b]).view(np.int64) for a, b in zip(begins, begins[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(np.diff(begins)), pa.array(distinct, pa.list_(pa.int64()))], ["n", "words"])

    numbered, chunks = _numbered(items)
    parsed = items.transform(bounded).mapInArrow(run, "n long, words array<long>")
    count, mean = parsed.where("n > 0").agg(F.count("*"), F.avg("n")).first()
    if not count:
        return
    frequency = parsed.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    for chunk in range(chunks):
        own = numbered.where(F.col("chunk") == chunk)
        rows = own.select("item_id", "text").orderBy("item_id", "text").toArrow().to_pylist()
        words, begins = word_hashes([r["text"] for r in rows])
        parts = [words[a:b] for a, b in zip(begins, begins[1:])]
        mine = own.select("text").transform(bounded).mapInArrow(run, "n long, words array<long>").select(F.explode("words").alias("word")).distinct()
        table = frequency.join(mine, "word").toArrow()
        df = dict(zip(table["word"].to_numpy().view(np.uint64).tolist(), table["df"].to_pylist()))
        classes: dict[int, list[int]] = {}
        for k, w in enumerate(parts):
            if len(w):
                classes.setdefault(max(LEAST_WINDOW, 1 << (len(w) - 1).bit_length()), []).append(k)
        out = []
        for own_class in classes.values():
            out.append(Index([rows[k]["item_id"] for k in own_class], [rows[k]["text"] for k in own_class], [parts[k] for k in own_class], df, count, mean))
        yield out


def best_hits(parts: list[Index], texts: list[str]) -> dict[tuple[int, int], tuple[float, float, float]]:
    """By text and item the best passage's score and overlaps."""
    words, begins = word_hashes(texts)
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for index in parts:
        for row, item, *values in index.hits(words, begins):
            best[row, item] = max(best.get((row, item), (0.0, 0.0, 0.0)), tuple(values))
    return best


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap``: the items found in every text."""
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    out = None
    for parts in indexes(items):
        shared = docs.sparkSession.sparkContext.broadcast(parts)

        def run(batches, shared=shared):
            for batch in slices(batches, 1024, 1_500_000):
                ids = batch["doc_id"].to_pylist()
                found = best_hits(shared.value, [t or "" for t in batch["text"].to_pylist()])
                rows = [(ids[row], item, *(round(v, 6) for v in values)) for (row, item), values in sorted(found.items())]
                columns = list(zip(*rows)) or [()] * 5
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in schema.split(", ")])

        one = docs.select("doc_id", "text").transform(bounded).mapInArrow(run, schema)
        out = one if out is None else out.union(one)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item was found, with all their columns."""
    at = docs.columns.index("text")
    for parts in indexes(items):
        shared = docs.sparkSession.sparkContext.broadcast(parts)

        def run(batches, shared=shared):
            for batch in slices(batches, 1024, 1_500_000):
                found = best_hits(shared.value, [t or "" for t in batch.column(at).to_pylist()])
                bad = {row for row, _ in found}
                yield batch.filter(pa.array([k not in bad for k in range(batch.num_rows)], pa.bool_()))

        docs = docs.transform(bounded).mapInArrow(run, docs.schema)
    return docs
