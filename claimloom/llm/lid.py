"""Operator 2: language identification by multinomial naive Bayes over hashed character n-grams.

Features are the n-grams of one to three characters inside words, the space before and after a word included; letters are
lower-cased and everything else counts as space. Each n-gram is hashed into one of ``BUCKETS`` columns. Counts per language
are summed over all training rows; the smoothed log probabilities, in fixed point, make a matrix of languages x BUCKETS,
whose size depends on the number of languages only (256 KB each) and which is broadcast. Scoring gathers matrix columns for
a slice of documents at once and sums them per document in whole numbers, so a score does not depend on what else is in
the slice. Texts are taken in pieces of bounded length.

Defined cases: null text and text without letters give ``und`` with score 0, as everything does if there is no training
row; equal likelihoods go to the language that sorts first; repeated rows give repeated rows; rows with null text or null
language are not learned from. Only the named columns are read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import bounded, slices

BUCKETS, ALPHA, SCALE, PIECE = 1 << 16, 0.5, 1 << 12, 1 << 19
UNKNOWN = "und"
#: How many languages' counts a task holds before it hands them on.
HELD = 32


@cache
def folded() -> np.ndarray:
    """By code point: the lower-case letter, or 0 for what is no letter. The code points after the last assigned letters are 0."""
    table = np.zeros(0x34000, np.uint32)
    for c in range(len(table)):
        if unicodedata.category(chr(c))[0] == "L":
            table[c] = ord(chr(c).lower()[0])
    return table


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all texts, three for each letter, as an array of shape (letters, 3); and where each text begins in it."""
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    table = folded()
    low = table[np.minimum(points, len(table) - 1)]
    letter = low > 0
    letter_before = np.concatenate(([True], letter[:-1]))  # a space is kept after a letter only, and at the very start
    at = np.flatnonzero(letter | letter_before)
    chars = np.concatenate(([0], low[at], [0])).astype(np.uint64)
    middle = np.flatnonzero(chars[1:-1]) + 1
    one, before, after = chars[middle], chars[middle - 1], chars[middle + 1]
    h = np.empty((len(middle), 3), np.int64)
    for k, value in enumerate((one, (one << np.uint64(21)) | after | np.uint64(1 << 63), (before << np.uint64(42)) | (one << np.uint64(21)) | after)):
        value = (value + np.uint64(k + 1)) * np.uint64(0x9E3779B97F4A7C15)  # 2^64 over the golden ratio
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)  # the multiplier of a published 64-bit mixer
        h[:, k] = (value >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1)
    return h, np.searchsorted(at[middle - 1], begins)


def pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Groups of texts with at most PIECE characters; longer texts are cut, between words where there is a space near the cut."""
    rows, group, size = [], [], 0
    for row, text in enumerate(texts):
        at = 0
        while at < len(text) or at == 0:
            end = min(len(text), at + PIECE)
            if end < len(text):
                space = text.rfind(" ", at + PIECE // 2, end)
                end = space + 1 if space >= 0 else end
            if size + end - at > PIECE and group:
                yield rows, group
                rows, group, size = [], [], 0
            rows.append(row)
            group.append(text[at:end])
            size += end - at
            if end >= len(text):
                break
            at = end
    if group:
        yield rows, group


def counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, bucket, n``: n-gram counts by language, and the number of documents at bucket -1. Sums within tasks, then one shuffle of at most
    languages x BUCKETS rows a task."""

    def run(batches):
        held: dict[str, np.ndarray] = {}
        docs_of: dict[str, int] = {}

        def out():
            for name, sums in sorted(held.items()):
                found = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * (len(found) + 1)), pa.array([-1, *found.tolist()], pa.int32()), pa.array([docs_of[name], *sums[found].tolist()], pa.int64())],
                    ["lang", "bucket", "n"],
                )
            held.clear()
            docs_of.clear()

        for batch in slices(batches, 1024, 1_500_000):
            langs, texts = batch["lang"].to_pylist(), batch["text"].to_pylist()
            for name in sorted(set(langs)):
                own = [t for t, x in zip(texts, langs) if x == name]
                if name not in held and len(held) >= HELD:
                    yield from out()
                sums = held.setdefault(name, np.zeros(BUCKETS, np.int64))
                docs_of[name] = docs_of.get(name, 0) + len(own)
                for _, group in pieces(own):
                    sums += np.bincount(grams(group)[0].ravel(), minlength=BUCKETS)
        yield from out()

    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    return rows.transform(bounded).mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Languages in order, their log priors, and log probabilities as whole numbers of 1 / SCALE."""

    def __init__(self, langs: list[str], priors: np.ndarray, matrix: np.ndarray):
        self.langs, self.priors, self.matrix = langs, priors, matrix


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learns from every row with a text and a language. The driver gets languages x BUCKETS sums."""
    table = counts(docs, text, lang).toArrow().to_pandas()
    langs = sorted(table["lang"].unique())
    sums, priors = np.zeros((BUCKETS, len(langs))), np.zeros(len(langs))
    for k, name in enumerate(langs):
        own = table[table["lang"] == name]
        grams_of = own[own["bucket"] >= 0]
        sums[grams_of["bucket"], k] = grams_of["n"]
        priors[k] = own.loc[own["bucket"] < 0, "n"].sum()
    logs = np.log((sums + ALPHA) / (sums.sum(0) + ALPHA * BUCKETS)) if langs else sums
    return Model(langs, np.log(priors / max(1, priors.sum())), np.round(logs * SCALE).astype(np.int64))


def scored(texts: list[str], m: Model) -> tuple[list[str], np.ndarray]:
    """The most likely language of every text and its posterior probability."""
    total, letters = np.zeros((len(texts), len(m.langs)), np.int64), np.zeros(len(texts), np.int64)
    if not m.langs:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    for rows, group in pieces(texts):
        h, begins = grams(group)
        sums = np.zeros((len(h) + 1, len(m.langs)), np.int64)
        np.cumsum(m.matrix[h[:, 0]] + m.matrix[h[:, 1]] + m.matrix[h[:, 2]], axis=0, out=sums[1:])
        np.add.at(total, rows, sums[begins[1:]] - sums[begins[:-1]])
        np.add.at(letters, rows, np.diff(begins))
    logs = total / SCALE + m.priors
    score = np.where(letters > 0, 1 / np.exp(logs - logs.max(1, keepdims=True)).sum(1), 0.0)
    return [m.langs[k] if n else UNKNOWN for k, n in zip(logs.argmax(1), letters)], np.round(score, 6)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score``, the score being the posterior probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches, 1024, 1_500_000):
            best, score = scored([t or "" for t in batch["text"].to_pylist()], shared.value)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(best, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").transform(bounded).mapInArrow(run, "doc_id long, lang_pred string, score double")


def identified(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of ``docs`` whose language is found with a score of ``least`` or more, with it as ``lang`` and all other columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text, lang = docs.columns.index("text"), docs.columns.index("lang")

    def run(batches):
        for batch in slices(batches, 1024, 1_500_000):
            best, score = scored([t or "" for t in batch.column(text).to_pylist()], shared.value)
            columns = list(batch.columns)
            columns[lang] = pa.array(best, columns[lang].type)
            kept = pa.array([b != UNKNOWN and s >= least for b, s in zip(best, score)], pa.bool_())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names).filter(kept)

    return docs.transform(bounded).mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    """Rows whose CRC-32 of the id's digits leaves 2 on division by 4 are not learned from; a null id counts as no digits."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2
