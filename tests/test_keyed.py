"""Joins with hot keys, and retrieval with and without pruning."""

import os
import random
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from claimloom.operators import approx, keyed, naive_bayes, retrieve
from claimloom.session import materialize


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_equals_join(spark, how):
    rng = random.Random(1)
    left = spark.createDataFrame([(i, rng.choice(["hot"] * 6 + [None, "a", "b", "none"])) for i in range(3000)], "id int, k string")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("a", 3), ("b", 4), ("other", 5), (None, 6)], "k string, v int")
    want = Counter(map(tuple, left.join(right, "k", how).collect()))
    for least in (10, 100, 100_000):
        got = keyed.split_join(left, right, "k", ["id"], how, pieces=16, least=least)
        assert got.columns == ["k", "id", "v"] and Counter(map(tuple, got.collect())) == want
    assert Counter(map(tuple, keyed.lookup(left, right, "k", ["id"], how).collect())) == want
    assert Counter(map(tuple, keyed.lookup(left, right, "k", ["id"], how, most=2).collect())) == want
    two = keyed.split_join(left.withColumn("j", F.lit(1)), right.withColumn("j", F.lit(1)), ["k", "j"], ["id"], how, pieces=16, least=10)
    assert two.count() == sum(want.values())


@pytest.mark.parametrize("how", ["inner", "left"])
def test_keys_and_columns_may_be_called_n_or_parts(spark, how):
    """A language model's key is its order, ``n``; the tables of a draw have a column ``parts``."""
    left = spark.createDataFrame([(i, 1 + i % 2, "hot" if i % 3 else None) for i in range(900)], "id int, n int, k string")
    right = spark.createDataFrame([(1, "hot", 7), (2, "hot", 8), (2, "cold", 9)], "n int, k string, parts int")
    want = Counter(map(tuple, left.join(right, ["n", "k"], how).select("n", "k", "id", "parts").collect()))
    for least in (10, 100_000):
        got = keyed.split_join(left, right, ["n", "k"], ["id"], how, pieces=16, least=least)
        assert got.columns == ["n", "k", "id", "parts"] and Counter(map(tuple, got.collect())) == want


def test_no_task_holds_a_hot_key(spark):
    """A term in every document: what one task joins stays near its share."""
    rows = spark.range(60_000).select("id", F.explode(F.array(F.lit("the"), F.concat(F.lit("t"), (F.col("id") % 997).cast("string")))).alias("term"))
    model = materialize(rows.select("term").distinct().withColumn("c", F.lit(1)), "model")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(kept, ("false", "-1", "16")):
            spark.conf.set(k, v)
        plain = rows.join(model, "term")
        split = keyed.split_join(rows, model, "term", ["id"], pieces=64, least=1000)
        most = lambda df: df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert most(plain) > 60_000 and most(split) < 25_000 and split.count() == 120_000
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_scores_do_not_depend_on_the_join(spark, monkeypatch):
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, rng.choice(["fake", "real"]), ["the"] + [rng.choice("abcdefgh") for _ in range(i % 9)]) for i in range(200)], "id int, label string, terms array<string>")
    from claimloom.operators.features import doc_terms

    model = naive_bayes.fit(doc_terms(docs, "label"), docs, "label", ("fake", "real")).materialized()
    score = lambda: {r["id"]: (r["prediction"], round(r["confidence"], 9)) for r in model.score(doc_terms(docs, "id", outer=True), "id").collect()}
    want = score()
    real = keyed.split_join
    monkeypatch.setattr(naive_bayes, "lookup", lambda left, right, keys, by, how: real(left, right, keys, by, how, pieces=8, least=20))
    assert score() == want and len(want) == 200


def weights(rng, n, n_terms, size):
    """Normalised rows whose frequent terms have small weights."""
    out = []
    for i in range(n):
        terms = {min(int(rng.paretovariate(0.7)) - 1, n_terms - 1) for _ in range(rng.randint(0, size))}
        row = [(i, t, (0.3 + rng.random()) * (1 + t) ** 0.9) for t in terms]
        norm = sum(w * w for *_, w in row) ** 0.5
        out += [(i, t, w / norm) for i, t, w in row]
    return out


def test_pruned_retrieval_equals_full(spark):
    rng = random.Random(3)
    corpus = materialize(spark.createDataFrame(weights(rng, 3000, 400, 30), "doc int, term_id int, weight double"), "corpus")
    asked = materialize(spark.createDataFrame(weights(rng, 40, 400, 12), "q int, term_id int, weight double"), "asked")
    queries = spark.createDataFrame([(i, 1 + i % 20) for i in range(42)], "q int, top_k int")
    docs = spark.range(3000).select(F.col("id").cast("int").alias("doc"))
    for top_k in (5, "top_k"):
        rows = [sorted(map(tuple, retrieve.similar(asked, corpus, queries, docs, "q", "doc", top_k, prune).collect())) for prune in (True, False)]
        assert rows[0] == rows[1] and len(rows[0]) == sum(5 if top_k == 5 else 1 + i % 20 for i in range(42))
    limits = queries.select("q", F.lit(5).alias("_k"))
    found = retrieve.pruned(asked, corpus, limits, "q", "doc")
    full = asked.select("q", "term_id").join(corpus, "term_id")

    pairs, all_pairs = found.formed.count(), full.select("q", "doc").distinct().count()
    assert pairs < all_pairs / 2 and found.scored.count() < all_pairs / 6 and all_pairs < 40 * 3000
    assert retrieve.similar(asked.limit(0), corpus, queries, docs, "q", "doc", 3).count() == 42 * 3
    assert retrieve.similar(asked, corpus.limit(0), queries, docs.limit(0), "q", "doc", 3).count() == 0


def test_approximate_retrieval(spark):
    """Of the pairs that are at least half alike nine in ten are found, with exact similarities; far fewer pairs are verified than exist."""
    rng = random.Random(7)
    base = [rng.sample(range(600), rng.randint(8, 40)) for _ in range(250)]
    rows = []
    for i in range(1500):
        terms = set(base[i % 250])
        terms -= set(rng.sample(sorted(terms), len(terms) * (i // 250) // 20))
        terms |= set(rng.sample(range(600), len(terms) * (i // 250) // 20))
        row = [(i, t, (0.5 + (t * 37 % 11) / 11)) for t in terms]
        norm = sum(w * w for *_, w in row) ** 0.5
        rows += [(i, t, w / norm) for i, t, w in row]
    corpus = materialize(spark.createDataFrame(rows, "doc int, term_id int, weight double"), "corpus")
    asked = materialize(corpus.where("doc % 50 = 0").withColumnRenamed("doc", "q"), "asked")
    queries, docs = spark.createDataFrame([(i,) for i in range(0, 1501, 50)], "q int"), spark.range(1500).select(F.col("id").cast("int").alias("doc"))
    exact = {(r["q"], r["doc"]): r["similarity"] for r in retrieve.similar(asked, corpus, queries, docs, "q", "doc", 6).collect()}
    got = {(r["q"], r["doc"]): r["similarity"] for r in approx.similar_approx(asked, corpus, queries, docs, "q", "doc", 6, 0.5).collect()}
    alike = {p for p, s in exact.items() if s >= 0.5}
    assert len(got) == 31 * 6 and len(alike) > 100 and len(alike & got.keys()) >= 0.9 * len(alike) and all(got[p] == exact[p] for p in alike & got.keys())
    assert approx.candidates(asked, corpus, "q", "doc").count() < 30 * 1500 / 4 and {s for p, s in got.items() if p not in alike} <= {0.0} | {exact.get(p) for p in got}
    assert approx.similar_approx(asked.limit(0), corpus, queries, docs, "q", "doc", 2).count() == 62


def test_approximate_retrieval_of_documents(spark):
    """The registered query against the exact search over the same documents."""
    from claimloom.plans import catalog, scoring

    folder = "/root/testdata/sf0.001"
    docs = catalog.documents(spark, folder)
    asked = docs.where("doc_id % 50 = 0").selectExpr("doc_id request_id", "text")
    exact = scoring.retrieve(docs, asked, "doc_id", "request_id").where("similarity >= 0.5").select("request_id", "doc_id", "similarity").collect()
    got = {tuple(r) for r in catalog.QUERIES["similar_approx"](spark, folder).select("request_id", "doc_id", "similarity").collect()}
    assert len(exact) >= 4 and sum(tuple(r) in got for r in exact) >= 0.9 * len(exact) and len(got) == 5 * asked.count()


def test_scratch_folder_without_a_setting(tmp_path):
    """A local session whose configuration names no shared folder can store tables."""
    code = (
        "from claimloom.session import local_session, materialize, shared_dir\n"
        "s = local_session(1, '1g')\n"
        "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
        "assert materialize(s.range(7), 'x').count() == 7 and shared_dir(s) == shared_dir(s)\n"
        "print('stored in', shared_dir(s)); s.stop()"
    )
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", code], env=env, cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    assert not Path(done.stdout.split("stored in ")[1].strip()).exists()
