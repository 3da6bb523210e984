"""Word vectors and their projections.

The trainer is skip-gram with negative sampling. No table of the whole vocabulary is held anywhere: the documents are dealt
into shares, a task trains the words of its share, and the vectors of a word are averaged over the shares that hold it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.operators.neighbours import neighbours
from claimloom.session import discard, materialize

# Vector size and window of the parameter grid.
GRID = ((100, 3), (200, 5), (300, 7))
# Negative words per pair; first and last learning rate; power of the noise distribution.
NEGATIVE, RATE, LEAST_RATE, NOISE = 5, 0.025, 0.025e-4, 0.75
# Words whose windows are one step, noise words drawn for a step, and steps whose pairs are listed together.
STEP, DRAWS, STEPS = 64, 64, 256
# Pairs of one word that count in full in one step: a word that fills a step would overshoot.
FULL = 32
# Rows of vectors that are averaged together in a task, about.
MERGED = 50_000


@dataclass(frozen=True)
class Shares:
    """Documents dealt by their content, and the frequent words of each share.

    ``docs`` has the columns given, ``share`` and ``row`` (a hash of the row, which orders a share); ``words`` is
    ``share, word, n, total``: how often the share and all documents hold the word.
    """

    docs: DataFrame
    words: DataFrame
    parts: int
    tokens: str


@dataclass(frozen=True)
class WordVectors:
    """``table`` is ``word, vector``; ``shares`` is what it was trained on."""

    table: DataFrame
    shares: Shares
    size: int

    def drop(self) -> None:
        """Deletes the stored vectors when nothing reads them any more."""
        discard(self.table)

    def transform(self, output: str = "features") -> DataFrame:
        """The documents trained on with the mean vector of their tokens; a token without a vector counts as zeros, and so does no token."""
        shares, tokens, size = self.shares, self.shares.tokens, self.size
        known = shares.words.select("share", "word").join(self.table.withColumn("vector", F.col("vector").cast("array<float>")), "word")
        kept = [c for c in shares.docs.columns if c not in ("share", "row", tokens)]
        given = shares.docs.select("share", tokens, F.struct(*kept).alias("kept"))
        both = given.unionByName(known, allowMissingColumns=True).repartitionById(shares.parts, "share")

        def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for docs, words in _by_share(batches, tokens):
                vectors = words["vector"].combine_chunks().flatten().to_numpy().reshape(-1, size)
                for lo in range(0, docs.num_rows, 1000):
                    part = docs.slice(lo, 1000)
                    ids, at, lengths = _coded(part[tokens], words["word"])
                    sums = np.zeros((part.num_rows, size))
                    for i, one in enumerate(np.split(ids, np.searchsorted(at, np.arange(1, part.num_rows)))):
                        sums[i] = vectors[one].sum(0, dtype="float64")
                    sums /= np.maximum(lengths, 1)[:, None]
                    flat = pa.array(sums.ravel())
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1) * size, "int32"), flat)
                    yield pa.RecordBatch.from_arrays([part["kept"].combine_chunks(), lists], ["kept", output])

        schema = f"kept {given.schema['kept'].dataType.simpleString()}, {output} array<double>"
        return both.mapInArrow(means, schema).select("kept.*", array_to_vector(output).alias(output))


def deal(docs: DataFrame, tokens: str = "tokens", min_count: int = 3, partitions: int | None = None) -> Shares:
    """The shares of ``docs``: 5,000 documents each, about, and at most 256; by the data alone, not by the cluster."""
    if partitions is None:
        partitions = max(1, min(256, docs.count() // 5000))
    row = F.xxhash64(*docs.columns)  # rows alike in all columns lie together; equal texts of different ids don't
    dealt = docs.withColumn("row", row).withColumn("share", F.pmod("row", F.lit(partitions)).cast("int"))
    found = dealt.select("share", F.explode(tokens).alias("word")).groupBy("share", "word").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("word"))  # a word has a row per share at most
    words = found.withColumn("total", total).where((F.col("total") >= min_count) & F.col("word").isNotNull())
    return Shares(dealt, materialize(words, "w2v-words"), partitions, tokens)


def train_word_vectors(
    docs: DataFrame, tokens: str = "tokens", size: int = 200, window: int = 5, min_count: int = 3, partitions: int | None = None
) -> WordVectors:
    """Skip-gram vectors of every word seen at least ``min_count`` times in all documents; every token is trained on once.

    ``docs`` is read several times and should be stored. A task holds its share's tokens and two vectors for each of its
    words; nothing is held for the whole vocabulary. The result follows from the rows and ``partitions`` alone.
    """
    return train(deal(docs, tokens, min_count, partitions), size, window)


def train(shares: Shares, size: int = 200, window: int = 5) -> WordVectors:
    """The same from dealt documents."""
    return WordVectors(materialize(trained(shares, size, window), "w2v-vectors"), shares, size)


def trained(shares: Shares, size: int = 200, window: int = 5) -> DataFrame:
    """``word, vector``, not stored: each read trains again. The vectors of the shares go to the tasks that average them and lie nowhere else."""
    tokens = shares.tokens
    given = shares.docs.select("share", "row", tokens)
    words = shares.words.withColumn("seed", F.xxhash64("word"))
    both = given.unionByName(words, allowMissingColumns=True).repartitionById(shares.parts, "share")

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs, words in _by_share(batches, tokens):
            if not words.num_rows:
                continue
            words, docs = words.sort_by("word"), docs.sort_by("row")
            share = words["share"][0].as_py()
            ids, at, _ = _coded(docs[tokens], words["word"])
            seeds, totals = (words[c].to_numpy() for c in ("seed", "total"))
            vectors = skip_grams(ids, at, totals, _start(seeds, size), window, np.random.default_rng([42, share]))
            for lo in range(0, len(vectors), 5000):
                part, some = words.slice(lo, 5000), vectors[lo : lo + 5000]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * size, "int32"), pa.array(some.ravel()))
                yield pa.RecordBatch.from_arrays([*(part[c].combine_chunks() for c in ("word", "n", "share")), lists], ["word", "n", "share", "vector"])

    vectors_of = both.mapInArrow(fitted, "word string, n long, share int, vector array<float>")
    lots = 1 + shares.words.count() // MERGED
    lot = F.pmod(F.xxhash64("word"), F.lit(lots)).cast("int")
    return vectors_of.withColumn("lot", lot).repartitionById(lots, "lot").mapInArrow(lambda b: _averaged(b, size), "word string, vector array<double>")


def _by_share(batches: Iterator[pa.RecordBatch], tokens: str) -> Iterator[tuple[pa.Table, pa.Table]]:
    """The documents and the words of each share of a partition."""
    docs, words = [], []
    for b in batches:
        t = pa.Table.from_batches([b])
        is_word = t["word"].is_valid()
        words.append(t.filter(is_word).drop_columns([tokens]))
        docs.append(t.filter(pc.invert(is_word)).drop_columns(["word"]))
    if not docs:
        return
    docs, words = pa.concat_tables(docs), pa.concat_tables(words)
    found = sorted(pc.unique(docs["share"]).to_pylist())
    if len(found) == 1:  # as a partition holds one share
        yield docs, words
        return
    for share in found:
        yield docs.filter(pc.equal(docs["share"], share)), words.filter(pc.equal(words["share"], share))


def _coded(texts: pa.ChunkedArray, words: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions in ``words`` of the known tokens, the row of each, and the number of all tokens of each row."""
    lengths = pc.fill_null(pc.list_value_length(texts), 0).to_numpy().astype("int64")
    flat = pc.list_flatten(texts)
    ids = pc.fill_null(pc.index_in(flat, value_set=words.combine_chunks()), -1).to_numpy().astype("int64")
    at = np.repeat(np.arange(len(lengths)), lengths)
    return ids[ids >= 0], at[ids >= 0], lengths


def _start(seeds: np.ndarray, size: int) -> np.ndarray:
    """The first vector of each word, from the word's hash alone and so alike in all shares: small, even around zero."""
    out = np.empty((len(seeds), size), "float32")
    steps = np.arange(1, size + 1, dtype="uint64") * np.uint64(0x9E3779B97F4A7C15)
    for lo in range(0, len(seeds), 10_000):
        x = seeds[lo : lo + 10_000].astype("int64").view("uint64")[:, None] + steps
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
        out[lo : lo + 10_000] = ((x >> np.uint64(40)).astype("float64") / 2**24 - 0.5) / size
    return out


def skip_grams(ids: np.ndarray, at: np.ndarray, totals: np.ndarray, vectors: np.ndarray, window: int, rng: np.random.Generator) -> np.ndarray:
    """``vectors`` trained once over the words ``ids`` of the texts ``at``, in place.

    A word predicts the words around it, at a distance drawn up to ``window``. The windows of 64 words are one step: the
    pairs of its different words are counted, and scores and gradients of all of them, and of noise words shared by the
    step, are matrix products.
    """
    out = np.zeros_like(vectors)
    noise = np.cumsum(totals.astype("float64") ** NOISE)
    for first in range(0, len(ids), STEP * STEPS):
        last = min(first + STEP * STEPS, len(ids))
        centre = np.arange(first, last)
        reach = rng.integers(1, window + 1, len(centre))
        drawn = np.minimum(np.searchsorted(noise, rng.random((STEPS, DRAWS)) * noise[-1], "right"), len(noise) - 1) if len(noise) else None
        pairs = []
        for d in (x for y in range(1, window + 1) for x in (-y, y)):
            c = centre[reach >= abs(d)]
            c = c[(c + d >= 0) & (c + d < len(ids))]
            pairs.append(np.stack([c, c + d])[:, at[c] == at[c + d]])
        c, near = np.concatenate(pairs, axis=1)
        step = (c - first) // STEP
        order = np.argsort(step, kind="stable")
        c, near, ends = c[order], near[order], np.searchsorted(step[order], np.arange((last - first - 1) // STEP + 2))
        for s in range(len(ends) - 1):
            lo, hi = ends[s], ends[s + 1]
            if lo == hi:
                continue
            done = first + s * STEP
            rate = max(RATE * (1 - done / len(ids)), LEAST_RATE)
            begin = max(0, done - window)
            words, code = np.unique(ids[begin : done + STEP + window], return_inverse=True)
            k = len(words)
            counts = np.bincount(code[near[lo:hi] - begin] * k + code[c[lo:hi] - begin], minlength=k * k).reshape(k, k).astype("float32")
            counts /= np.maximum(1, np.maximum(counts.sum(1)[:, None], counts.sum(0)) / FULL)
            wrong, times = np.unique(drawn[s], return_counts=True)
            share = (times * (NEGATIVE / DRAWS)).astype("float32")
            place = np.minimum(np.searchsorted(words, wrong), k - 1)
            misses = counts.sum(1)[:, None] - counts[:, place] * (words[place] == wrong)  # a word is no noise for itself
            misses *= share
            misses /= np.maximum(1, misses.sum(0) / FULL)
            x, y, z = vectors[words], out[words], out[wrong]
            g = counts * (rate / (1 + np.exp(np.clip(x @ y.T, -30, 30))))
            h = misses * (rate / (1 + np.exp(np.clip(-(x @ z.T), -30, 30))))
            vectors[words] = x + g @ y - h @ z
            out[words] = y + g.T @ x
            out[wrong] -= h.T @ x
    return vectors


def _averaged(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The mean vector of each word, a share counting as often as it holds the word, summed in the order of shares."""
    batches = [*batches]
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    table = table.take(pc.sort_indices(table, [("word", "ascending"), ("share", "ascending")]))
    words, n = table["word"].combine_chunks().dictionary_encode(), table["n"].to_numpy().astype("float64")
    firsts = np.flatnonzero(np.diff(words.indices.to_numpy(), prepend=-1))
    vectors = table["vector"].combine_chunks().flatten().to_numpy().reshape(-1, size)
    weights = np.add.reduceat(n, firsts)
    for lo in range(0, len(firsts), 5000):
        some = firsts[lo : lo + 5000]
        end = firsts[lo + 5000] if lo + 5000 < len(firsts) else len(n)
        rows = slice(some[0], end)
        means = np.add.reduceat(vectors[rows] * n[rows, None], some - some[0]) / weights[lo : lo + 5000, None]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * size, "int32"), pa.array(means.ravel()))
        yield pa.RecordBatch.from_arrays([words.dictionary.slice(lo, 5000), lists], ["word", "vector"])


def word_vectors(model: WordVectors) -> DataFrame:
    """``word, vector`` with plain arrays."""
    return model.table


def similar_words(words: DataFrame, asked: DataFrame, k: int = 10) -> DataFrame:
    """``query, word, similarity, rank``: the ``k`` words nearest to each word of ``asked(word)`` that has a vector, by cosine."""
    found = neighbours(words, words.join(asked.select("word").distinct(), "word", "left_semi"), "word", "vector", k)
    return found.withColumnRenamed("key", "word")


def project(table: DataFrame, key: str, vector: str, k: int = 2) -> DataFrame:
    """``key, x1..xk``: principal components of an array column (a size x size matrix on the driver)."""
    dense = table.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(dense)
    out = model.transform(dense).withColumn("_p", vector_to_array("_p"))
    return out.select(key, *[F.get("_p", F.lit(i)).alias(f"x{i + 1}") for i in range(k)])


def grid_models(docs: DataFrame, tokens: str, grid: Sequence[tuple[int, int]] = GRID, **kwargs):
    """``(size, window, model)`` for each grid point."""
    shares = deal(docs, tokens, **kwargs)
    for size, window in grid:
        yield size, window, train(shares, size, window)
