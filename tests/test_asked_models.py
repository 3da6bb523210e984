"""Models fitted for asked contexts alone: the answers of the whole model, from packed n-grams."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimloom.operators import ngram_asked, ngram_lm
from claimloom.plans import catalog

ROWS = [("x", "aa bb cc"), ("x", "aa bb"), ("y", ""), ("y", "aa bb cc aa bb dd"), ("y", "ünï aa bb"), ("x", "dd " * 70), (None, "aa bb cc dd")]


def texts(spark):
    rng = random.Random(7)
    more = [(rng.choice("xy"), " ".join(rng.choice("abcdefgh") * 2 for _ in range(rng.randrange(30)))) for _ in range(60)]
    rows = [(label, text.split()) for label, text in ROWS + more] + [("x", None)]
    return spark.createDataFrame(rows, "label string, tokens array<string>").repartition(3)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("n, by", [(1, []), (2, ["label"]), (3, []), (3, ["label"])])
def test_the_tables_are_those_of_the_whole_model(spark, monkeypatch, n, by):
    monkeypatch.setattr(ngram_asked, "RANGE", 200)  # many ranges
    docs = texts(spark).where("label is not null")
    asked = spark.createDataFrame([("aa bb", "cc"), ("aa bb", "aa"), ("aa bb", "no"), ("zz bb", "dd"), ("<s> <s>", "aa"), ("zz yy", "cc"), ("ünï aa", "bb"), ("dd dd", None), (None, "aa")], "context string, word string")
    whole, small = ngram_lm.fit(docs, n, by=by), ngram_asked.fit_for(docs, asked.select("context"), n, by=by)
    suffixes = asked.select(F.inline(ngram_lm.suffix_orders(F.col("context"), n))).union(spark.createDataFrame([(1, "")], "n int, context string")).distinct()
    kept = whole.counts.join(suffixes, ["n", "context"], "left_semi")
    assert rows(small.counts, *by, "n", "context", "word", "cnt") == rows(kept, *by, "n", "context", "word", "cnt")
    want = whole.contexts.join(suffixes, ["n", "context"], "left_semi")
    assert rows(small.contexts, *by, "n", "context", "total", "followers") == rows(want, *by, "n", "context", "total", "followers")
    assert rows(small.words, *by, "n", "word", "p_cont") == rows(whole.words, *by, "n", "word", "p_cont")
    # with words: the same contexts, and counts of the asked n-grams alone
    pairs = ngram_asked.fit_for(docs, asked, n, by=by)
    assert rows(pairs.contexts, *by, "n", "context", "total", "followers") == rows(want, *by, "n", "context", "total", "followers")
    assert set(rows(pairs.counts.where("n > 1"), *by, "n", "context", "word", "cnt")) <= set(rows(kept, *by, "n", "context", "word", "cnt"))
    grams = asked.where("context is not null and word is not null" if n > 1 else "false").distinct()
    if by:
        grams = grams.withColumn("label", F.explode(F.array(F.lit("x"), F.lit("y"))))
    if n == 3:
        assert rows(ngram_lm.probabilities(pairs, grams), *by, "context", "word", "level", "p") == rows(ngram_lm.probabilities(whole, grams), *by, "context", "word", "level", "p")


def test_nothing_trained_on_and_nothing_asked(spark):
    docs, asked = texts(spark), spark.createDataFrame([("aa bb",)], "context string")
    for d, a in ((docs.limit(0), asked), (docs, asked.limit(0)), (docs.where("tokens is null"), asked)):
        model = ngram_asked.fit_for(d, a)
        assert model.contexts.where("n > 1").count() == 0
        assert (model.words.count() > 0) == (d is docs)


def test_long_rows_have_keys_too():
    """Rows of more numbers than one key holds are told apart, in order."""
    columns = [np.random.default_rng(i).integers(0, 3, 500) + 2**30 for i in range(4)]
    key = ngram_asked._key(columns, 2**30 + 3)
    order = np.lexsort(columns[::-1])
    rows = np.stack(columns)[:, order].T.tolist()
    assert [a == b for a, b in zip(rows, rows[1:])] == [a == b for a, b in zip(key[order], key[order][1:])] and (np.diff(key[order]) >= 0).all()


def test_long_texts_and_groups_are_cut_between_texts():
    """Every text is whole in one group, and counts of all groups together are those of all texts."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"tokens": [["aa"] * 700_000, ["aa", "bb"], None, ["aa"] * 600_000, ["bb"]]}, pa.schema([("tokens", pa.list_(pa.string()))]))
    packed = list(ngram_asked._packed(iter([batch, batch]), 2, 3, [], "tokens"))
    assert len({(b["part"][0].as_py(), b["n"][0].as_py()) for b in packed}) < len(packed)  # more than one group
    got = {}
    for b in ngram_asked._answers(iter(packed), [], False):
        for r in b.to_pylist():
            if r["n"] == 1:
                got[r["word"]] = got.get(r["word"], 0) + r["cnt"]
    assert got == {"aa": 2 * 1_300_001, "bb": 4, "</s>": 8}


@pytest.mark.parametrize("name", ["kn_prob", "kn_perplexity", "kn_perplexity_by_text", "kn_next_word", "kn_sample_word", "lm_classify"])
def test_no_query_lists_the_trigrams_of_the_documents(spark, monkeypatch, tmp_path, name):
    """Only what is asked is unfolded into rows; the documents' n-grams are packed."""
    folder, rng = str(tmp_path), random.Random(1)
    said = lambda: " ".join(rng.choice("abcdefgh") * 2 for _ in range(9))
    spark.createDataFrame([(i, said()) for i in range(60)], "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(i, 1, "user", said()) for i in range(5)], "conv_id long, turn int, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    unfolded, real = [], ngram_lm.explode_ngrams
    monkeypatch.setattr(ngram_lm, "explode_ngrams", lambda docs, *a, **k: unfolded.append(docs) or real(docs, *a, **k))
    monkeypatch.setattr(ngram_lm, "ngram_counts", lambda *a, **k: pytest.fail("every n-gram as a row"))
    assert catalog.QUERIES[name](spark, folder).count() > 0
    assert len(unfolded) == (name not in ("kn_next_word", "kn_sample_word"))
