"""What keeps a query's work in step with its input."""

import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from claimloom.functions import tokens
from claimloom.operators import naive_bayes, ngram_lm
from claimloom.operators.features import counted, doc_terms
from claimloom.plans import catalog
from claimloom.session import materialize

TEXTS = ["The cats sat on the mats, cannot see", "Women said the foxes ran ran ran", "", None, "don't 'tis gonna be the cats"]


@pytest.fixture()
def folder(spark, tmp_path):
    rows = [(i, TEXTS[i % 5], ("en", "de", None)[i % 3]) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_raw_files_of_a_language_are_bounded(spark, folder, monkeypatch):
    roots = []
    path = catalog.fresh_path
    monkeypatch.setattr(catalog, "fresh_path", lambda s, name: roots.append(path(s, name)) or roots[-1])
    monkeypatch.setattr(catalog, "RAW_ROWS", 10)
    got = {tuple(r) for r in catalog.QUERIES["ingest_incremental"](spark, folder).collect()}
    assert got == {(1, "cleaned", 3), (2, "skipped", 3)}
    files = [f.read_text().splitlines() for f in Path(roots[0], "raw").rglob("part-*.csv")]
    assert len(files) >= 6 and max(map(len, files)) <= 11  # with the header


@pytest.mark.parametrize("n", [1, 2, 3])
def test_shorter_ngrams_are_sums_of_the_longest(spark, monkeypatch, n):
    rng = random.Random(n)
    rows = [(i, rng.choice("xy"), [rng.choice(["a", "b", "c"]) for _ in range(i % 6)]) for i in range(80)]
    docs = spark.createDataFrame(rows, "id int, label string, tokens array<string>")
    want = Counter()
    for _, label, words in rows:
        for k in range(1, n + 1):
            padded = ["<s>"] * (k - 1) + words + ["</s>"]
            want.update((label, k, " ".join(padded[i : i + k - 1]), padded[i + k - 1]) for i in range(len(padded) - k + 1))
    asked, real = [], ngram_lm.explode_ngrams
    monkeypatch.setattr(ngram_lm, "explode_ngrams", lambda *a, **k: asked.append(k["orders"]) or real(*a, **k))
    got = ngram_lm.ngram_counts(docs, n, "label").collect()
    assert {tuple(r[c] for c in ("label", "n", "context", "word")): r["cnt"] for r in got} == want and len(got) == len(want)
    assert asked == [[n]]  # texts are unfolded once, whatever the number of orders


def test_terms_are_counted_as_bytes_and_once(spark):
    rng = random.Random(1)
    rows = [(i, None if i % 7 == 0 else [rng.choice(["a", "\u00e9", "zz", "\U0001d518", "\uff5e", "b b", "", None]) for _ in range(i % 9)]) for i in range(100)]
    docs = spark.createDataFrame(rows, "id int, terms array<string>")
    got = {r["id"]: [tuple(t) for t in r["c"]] for r in docs.select("id", tokens.term_counts(F.col("terms")).alias("c")).collect()}
    for i, words in rows:
        assert got[i] == sorted(Counter(w for w in words or [] if w is not None).items(), key=lambda t: t[0].encode())
    stored = materialize(counted(docs), "counted")
    assert "_counted" not in doc_terms(stored, "id")._jdf.queryExecution().toString()
    assert Counter(doc_terms(stored, "id", outer=True).collect()) == Counter(doc_terms(docs, "id", outer=True).collect())


def test_frequent_terms_of_a_large_model_are_broadcast(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["fake", "real"]), ["the"] * 2 + [rng.choice("abcdefghij") for _ in range(i % 9)] * (i % 5 > 0)) for i in range(200)]
    docs = spark.createDataFrame(rows + [(200, "fake", [])], "id int, label string, terms array<string>")
    model = naive_bayes.fit(doc_terms(docs.where("id % 2 = 0"), "label"), docs, "label", ("fake", "real")).materialized()
    asked = doc_terms(docs, "id", outer=True).unionByName(spark.createDataFrame([(7, "never seen", 3)], "id int, term string, tf long"))
    rows = lambda df: Counter(df.select("id", "term", "tf", "c0", "c1").collect())
    want = rows(asked.join(model.counts, "term", "left"))
    for most in (2, 5, 100):
        assert rows(model._with_counts(asked, ["id"], most)) == want


@pytest.mark.parametrize("name", ["lemma_noun", "lemma_verb", "normalized_tokens"])
def test_lemma_queries_clean_the_texts_once(spark, folder, name):
    plan = catalog.QUERIES[name](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan  # what the texts were split into is stored
