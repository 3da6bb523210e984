"""Word vectors are trained in shares: the whole text, the same whatever the partitions, and nothing whole on the driver."""

import os
import random
from collections import Counter

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from claimloom import session
from claimloom.operators import neighbours, vectors


def topics(n=240):
    rng = random.Random(3)
    words = [[f"{t}{i}" for i in range(8)] for t in "ab"]
    rows = [(i, [rng.choice(words[i % 2]) for _ in range(40)]) for i in range(n)]
    return rows + [(n, ["a0", "once"]), (n + 1, []), (n + 2, None), (None, ["twice", "twice", "a1"]), (n, ["a0", "once"]), (n + 3, ["once"])]


SCHEMA = "id long, tokens array<string>"


def test_shares_train_every_frequent_word(spark):
    rows = topics()
    counts = Counter(w for _, t in rows for w in t or [])
    docs = spark.createDataFrame(rows, SCHEMA)
    for parts in (1, 4):
        model = vectors.train_word_vectors(docs, size=16, window=3, partitions=parts)
        got = {r["word"]: np.array(r["vector"]) for r in vectors.word_vectors(model).collect()}
        assert set(got) == {w for w, n in counts.items() if n >= 3} and "once" in got and "twice" not in got
        assert all(v.shape == (16,) and np.isfinite(v).all() for v in got.values())
        # the same from other partitions and another order of rows
        again = vectors.train_word_vectors(spark.createDataFrame(rows[::-1], SCHEMA).repartition(5), size=16, window=3, partitions=parts)
        assert {r["word"]: r["vector"] for r in vectors.word_vectors(again).collect()} == {w: v.tolist() for w, v in got.items()}


def test_words_of_one_topic_are_near(spark):
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, [f"{'ab'[i % 2]}{rng.randrange(8)}" for _ in range(400)]) for i in range(400)], SCHEMA)
    words = vectors.word_vectors(vectors.train_word_vectors(docs, size=16, partitions=4))
    near = vectors.similar_words(words, spark.createDataFrame([("a0",), ("b0",)], "word string"), 7).collect()
    assert len(near) == 14 and all(r["query"][0] == r["word"][0] for r in near)


def test_documents_have_the_mean_of_their_words(spark):
    rows = topics(30)
    docs = spark.createDataFrame(rows, SCHEMA)
    model = vectors.train_word_vectors(docs, size=6, window=2, partitions=3)
    known = {r["word"]: np.array(r["vector"]) for r in model.table.collect()}
    got = model.transform().select("id", vector_to_array("features").alias("v")).collect()
    key = lambda i: (i is None, i)
    want = sorted(((i, sum((known.get(w, np.zeros(6)) for w in t or []), np.zeros(6)) / max(1, len(t or []))) for i, t in rows), key=lambda x: key(x[0]))
    got = sorted(((r["id"], np.array(r["v"])) for r in got), key=lambda x: key(x[0]))
    assert [i for i, _ in got] == [i for i, _ in want]
    for (_, a), (_, b) in zip(got, want, strict=True):
        assert np.allclose(a, b, atol=1e-6)


def test_no_frequent_word_no_vector(spark):
    docs = spark.createDataFrame([(1, ["a", "b"]), (2, None)], SCHEMA)
    for d in (docs, docs.limit(0)):
        model = vectors.train_word_vectors(d, size=4)
        assert vectors.word_vectors(model).count() == 0
        assert all(r["v"] == [0.0] * 4 for r in model.transform().select(vector_to_array("features").alias("v")).collect())


def test_a_step_is_the_sum_of_its_pairs():
    rng = np.random.default_rng(1)
    v, n, window = 12, 50, 3
    ids, at, totals = rng.integers(0, v, n), np.repeat([0, 1], n // 2), np.arange(1, v + 1)
    begin = rng.normal(size=(v, 5)).astype("float32")
    # two steps would need 128 words: of one step the gradients of the outer vectors start at zero, so a first step is given
    out, first = np.zeros((v, 5)), begin.astype("float64")
    draws = np.random.default_rng(7)
    reach = draws.integers(1, window + 1, n)
    noise = np.cumsum(totals**vectors.NOISE)
    wrong = np.searchsorted(noise, draws.random((vectors.STEPS, vectors.DRAWS)) * noise[-1], "right")[0]
    moved = first.copy()
    share = vectors.NEGATIVE / vectors.DRAWS
    pairs = [(ids[c + d], ids[c]) for c in range(n) for d in range(-reach[c], reach[c] + 1) if d and 0 <= c + d < n and at[c + d] == at[c]]
    counts = np.zeros((v, v))
    np.add.at(counts, tuple(np.array(pairs).T), 1)
    counts /= np.maximum(1, np.maximum(counts.sum(1)[:, None], counts.sum(0)) / vectors.FULL)
    misses = np.stack([(counts.sum(1) - counts[:, w]) * (wrong == w).sum() * share for w in range(v)], axis=1)
    misses /= np.maximum(1, misses.sum(0) / vectors.FULL)
    moved += vectors.RATE * (counts / 2 - misses / 2) @ out
    out += vectors.RATE * (counts / 2 - misses / 2).T @ first
    got = vectors.skip_grams(ids, at, totals, begin.copy(), window, np.random.default_rng(7))
    assert np.allclose(got, moved, atol=1e-5)
    # with the same text twice in one call the outer vectors of the first step move the inner ones
    both = vectors.skip_grams(np.tile(ids, 3), np.repeat(range(6), n // 2), totals, begin.copy(), window, np.random.default_rng(7))
    assert not np.allclose(both, begin, atol=1e-5) and out.any()


def test_one_word_again_and_again_stays_finite():
    ids = np.zeros(5000, "int64")
    ids[::7] = 1
    got = vectors.skip_grams(ids, np.zeros(5000, "int64"), np.array([4000, 700]), vectors._start(np.array([5, 6]), 50), 5, np.random.default_rng(1))
    assert np.isfinite(got).all() and np.abs(got).max() < 20


def test_a_norm_is_taken_once_for_a_vector(spark):
    table = spark.createDataFrame([(1, [3.0, 4.0])], "id long, v array<double>")
    found = neighbours.blocks(table, "id", "v")
    assert "transform(" not in found._jdf.queryExecution().optimizedPlan().toString()  # there it would be taken for each component
    assert found.collect()[0].norms == [5.0]


def test_vectors_of_shares_are_not_stored(spark, monkeypatch):
    """They are a few times the input; only averages are written, and not even these where they are read once."""
    stored, real = [], vectors.materialize
    monkeypatch.setattr(vectors, "materialize", lambda df, name: stored.append(name) or real(df, name))
    shares = vectors.deal(spark.createDataFrame(topics(30), SCHEMA), partitions=2)
    lazy = {r["word"]: r["vector"] for r in vectors.trained(shares, 6, 2).collect()}
    assert stored == ["w2v-words"]
    model = vectors.train(shares, 6, 2)
    assert stored == ["w2v-words", "w2v-vectors"] and lazy == {r["word"]: r["vector"] for r in model.table.collect()}
    files = [f.removeprefix("file://") for f in model.table.inputFiles()]
    model.drop()
    assert files and not any(os.path.exists(f) for f in files)
    assert shares.words.count()


def test_discard_leaves_other_tables(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/kept")
    session.discard(spark.read.parquet(f"{tmp_path}/kept"))
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 3


def test_few_and_many_queries_find_the_same(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(300)] + [(5, [1.0, 0.0, 0.0, 0.0]), (None, [1.0] * 4), (301, None), (302, [0.0] * 4), (303, [1.0, None, 0.0, 0.0])]
    table = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    found = lambda: sorted(map(tuple, neighbours.neighbours(table, table.where("id % 7 = 0"), "id", "v", 4, block=32).collect()))
    got = found()
    monkeypatch.setattr(neighbours, "FEW", 0)
    assert got == found() and len(got) == 4 * 43
