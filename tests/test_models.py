import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from claimloom.operators import evaluate, features, naive_bayes, ngram_lm, retrieve, sampling

CLASSES = ("fake", "real")


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [
        (1, "fake", ["cure", "virus", "secret", "cure"]),
        (2, "real", ["health", "report", "virus"]),
        (3, "real", ["report", "cases", "health", "health"]),
        (4, "fake", ["secret", "chip"]),
        (5, "real", []),
    ]
    return spark.createDataFrame(rows, "id int, label string, terms array<string>")


def test_nb_golden(spark):
    docs = spark.createDataFrame([(0, "c0", ["fake", "news"]), (1, "c1", ["real", "report"])], "id int, label string, terms array<string>")
    model = naive_bayes.fit(features.doc_terms(docs, "label"), docs, "label", ("c0", "c1"))
    test = spark.createDataFrame([(7, ["fake", "news"]), (8, ["unknown"]), (9, [])], "id int, terms array<string>")
    out = {r["id"]: r for r in model.score(features.doc_terms(test, "id", outer=True), "id").collect()}
    assert out[7]["prediction"] == "c0"
    assert out[7]["probabilities"]["c0"] == pytest.approx(0.8)
    assert out[7]["scores"]["c0"] == pytest.approx(math.log(0.5) + 2 * math.log(2 / 6))
    # ties go to the smallest class, an empty document scores the prior
    assert out[8]["prediction"] == "c0" and out[8]["scores"]["c1"] == pytest.approx(math.log(0.5) + math.log(1 / 6))
    assert out[9]["scores"]["c0"] == pytest.approx(math.log(0.5))


def test_nb_against_brute_force(spark, corpus):
    rows = corpus.collect()
    counts = {c: Counter(t for r in rows if r["label"] == c for t in r["terms"]) for c in CLASSES}
    width = len({t for c in CLASSES for t in counts[c]})
    model = naive_bayes.fit(features.doc_terms(corpus, "label"), corpus, "label", CLASSES).materialized()
    for alpha in (0.1, 1.0):
        out = {r["id"]: r for r in model.score(features.doc_terms(corpus, "id", outer=True), "id", alpha=alpha).collect()}
        for r in rows:
            for c in CLASSES:
                total = sum(counts[c].values())
                want = math.log(sum(x["label"] == c for x in rows) / len(rows))
                want += sum(math.log((counts[c][t] + alpha) / (total + alpha * width)) for t in r["terms"])
                assert out[r["id"]]["scores"][c] == pytest.approx(want)
            assert sum(out[r["id"]]["probabilities"].values()) == pytest.approx(1)
    sweep = naive_bayes.alpha_sweep(model, features.doc_terms(corpus, "id", "label", outer=True), "id", "label")
    assert sweep.count() == 6 * len(rows)


def test_tfidf_matches_formula(spark, corpus):
    model = features.fit_terms(corpus)
    vocab = {r["term"]: r for r in model.vocabulary.collect()}
    assert [vocab[t]["term_id"] for t in sorted(vocab)] == list(range(len(vocab)))
    assert vocab["virus"]["idf"] == pytest.approx(math.log(6 / 3) + 1)
    weights = defaultdict(dict)
    for r in model.weights(corpus, "id").collect():
        weights[r["id"]][r["term"]] = r["weight"]
    for doc in weights.values():
        assert sum(w * w for w in doc.values()) == pytest.approx(1)
    assert 5 not in weights
    raw = {t: n * vocab[t]["idf"] for t, n in {"cure": 2, "virus": 1, "secret": 1}.items()}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    assert weights[1] == pytest.approx({t: v / norm for t, v in raw.items()})
    # the ML pipeline holds the same weights
    row = model.vectorizer().transform(corpus.where("id = 1")).first()["features"]
    assert {int(i): float(v) for i, v in zip(row.indices, row.values)} == pytest.approx(
        {vocab[t]["term_id"]: w for t, w in weights[1].items()}
    )
    small = features.top_vocabulary(corpus, 2)
    assert [(r["term"], r["tf"]) for r in small.orderBy("term").collect()] == [("cure", 2), ("health", 3)]
    with pytest.raises(ValueError):
        features.fit_terms(corpus, variant="other")


def brute_kn(sentences, n, d=0.75):
    """Plain recursive model used only to check the joins."""
    tables = {}
    for k in range(1, n + 1):
        counts = defaultdict(Counter)
        for s in sentences:
            t = ["<s>"] * (k - 1) + s + ["</s>"]
            for i in range(len(t) - k + 1):
                counts[tuple(t[i : i + k - 1])][t[i + k - 1]] += 1
        cont = Counter(w for c in counts.values() for w in c)
        tables[k] = (counts, cont, sum(cont.values()))

    def p(word, context, k):
        counts, cont, total = tables[k]
        if context not in counts:
            return p(word, context[1:], k - 1)
        seen = counts[context]
        size = sum(seen.values())
        return max(seen[word] - d, 0) / size + d * len(seen) / size * cont[word] / total

    return lambda word, context: p(word, tuple(context), n)


SENTENCES = [["a", "b", "c"], ["a", "c"], ["b", "c", "a", "b"], ["d", "a"], ["a", "b", "d"]]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_kn_probabilities_against_brute_force(spark, n):
    docs = spark.createDataFrame([(i, s) for i, s in enumerate(SENTENCES)], "id int, tokens array<string>")
    model = ngram_lm.fit(docs, n).materialized()
    p = brute_kn(SENTENCES, n)
    words = ["a", "b", "c", "d", "</s>", "zz"]
    contexts = [[]] if n == 1 else ([["a"], ["zz"], ["<s>"]] if n == 2 else [["a", "b"], ["zz", "b"], ["zz", "zz"], ["<s>", "<s>"]])
    grams = spark.createDataFrame([(" ".join(c), w) for c in contexts for w in words], "context string, word string")
    out = {(r["context"], r["word"]): r["p"] for r in ngram_lm.probabilities(model, grams).collect()}
    assert len(out) == len(contexts) * len(words)
    for c in contexts:
        for w in words:
            assert out[" ".join(c), w] == pytest.approx(p(w, c)), (c, w)
        assert sum(out[" ".join(c), w] for w in words) == pytest.approx(1)
    # the k best next words, against the whole vocabulary
    asked = spark.createDataFrame([(" ".join(c),) for c in contexts], "context string")
    ranked = defaultdict(list)
    for r in ngram_lm.next_words(model, asked, 3).orderBy("context", "rank").collect():
        ranked[r["context"]].append((r["word"], r["p"]))
    for c in contexts:
        best = sorted(((round(p(w, c), 9), w) for w in words if p(w, c) > 0), key=lambda x: (-x[0], x[1]))[:3]
        assert ranked[" ".join(c)] == [(w, v) for v, w in best]


def test_kn_golden_and_perplexity(spark):
    docs = spark.createDataFrame([(0, ["a", "b"]), (1, ["a", "c"])], "id int, tokens array<string>")
    model = ngram_lm.fit(docs, 2)
    grams = spark.createDataFrame([("<s>", "a"), ("a", "b"), ("a", "</s>"), ("b", "</s>")], "context string, word string")
    out = {(r["context"], r["word"]): r["p"] for r in ngram_lm.probabilities(model, grams).collect()}
    assert out == pytest.approx({("<s>", "a"): 0.7, ("a", "b"): 0.275, ("a", "</s>"): 0.3, ("b", "</s>"): 0.55})
    assert ngram_lm.corpus_perplexity(model, docs.where("id = 0")).first()["perplexity"] == pytest.approx(2.1138, abs=1e-4)
    assert ngram_lm.corpus_perplexity(model, docs.limit(0)).first()["perplexity"] == math.inf
    assert {r[0] for r in ngram_lm.lm_vocabulary(docs, 2).collect()} == {"a", "b", "c", "<s>", "</s>"}


def test_next_word_sampling_follows_the_distribution(spark):
    docs = spark.createDataFrame([(i, s) for i, s in enumerate(SENTENCES)], "id int, tokens array<string>")
    model = ngram_lm.fit(docs, 2).materialized()
    p = brute_kn(SENTENCES, 2)
    # contexts never seen all stand on the same level, and each draws for itself
    asked = spark.createDataFrame([(f"unseen{i}",) for i in range(1500)], "context string")
    seen = Counter(r["word"] for r in ngram_lm.sample_next(model, asked).collect())
    words = {"a", "b", "c", "d", "</s>"}
    assert set(seen) <= words and sum(seen.values()) == 1500
    assert all(abs(seen[w] / 1500 - p(w, ["unseen"])) < 0.05 for w in words)
    one = spark.createDataFrame([("a",)], "context string")
    after = Counter(ngram_lm.sample_next(model, one, seed).first()["word"] for seed in range(8))
    assert set(after) <= words and ngram_lm.sample_next(model, one, 3).collect() == ngram_lm.sample_next(model, one, 3).collect()
    padded = spark.createDataFrame([(["x"],), (["x", "y", "z"],)], "t array<string>").select(ngram_lm.fit_context(F.col("t"), 3))
    assert [r[0] for r in padded.collect()] == ["<s> x", "y z"]


@pytest.mark.parametrize("rows", [50_000, 100, 1])
def test_draw_descends_ranges(spark, monkeypatch, rows):
    """The same words however many steps, ranges and salts there are, also where one word has most of the weight."""
    monkeypatch.setattr(ngram_lm, "RANGE_ROWS", rows)
    weights = [(k, f"w{i}", 4000.0 if i == 7 else 1.0 + i % 3) for k in (1, 2) for i in range(300 * k)]
    asked = [(f"c{k}-{j}", k, (j + 0.5) / 400) for k in (1, 2) for j in range(400)]
    got = ngram_lm._drawn(spark.createDataFrame(weights, "n int, word string, w double"), spark.createDataFrame(asked, "full string, n int, u double"), "n")
    want = {}
    for full, k, u in asked:
        own = sorted((hashlib.md5(w.encode()).hexdigest(), w, x) for n, w, x in weights if n == k)
        at = u * sum(x for *_, x in own)
        for _, w, x in own:
            if at < x:
                break
            at -= x
        want[full] = w
    out = got.collect()
    assert len(out) == len(asked) and {r["full"]: r["word"] for r in out} == want
    assert ngram_lm._prefix(300, 1) == 4 and ngram_lm._prefix(3 * 10**9, 50_000) == 4 and ngram_lm._prefix(10, 50_000) == 2


def test_lm_classifier(spark):
    rows = [(0, "fake", ["x", "y"]), (1, "fake", ["x", "y", "x"]), (2, "real", ["p", "q"]), (3, "real", ["p", "q", "p"])]
    docs = spark.createDataFrame(rows, "id int, label string, tokens array<string>")
    model = ngram_lm.fit(docs, 2, by=["label"]).materialized()
    test = spark.createDataFrame([(9, ["x", "y"]), (10, ["p", "q"])], "id int, tokens array<string>")
    out = {r["id"]: r["prediction"] for r in ngram_lm.classify_by_perplexity(model, test, "id", "label").collect()}
    assert out == {9: "fake", 10: "real"}


def test_lm_of_two_keys(spark):
    rows = [("fake", "x", ["a", "b"]), ("fake", "y", ["b", "a"]), ("real", "x", ["b", "b"])]
    model = ngram_lm.fit(spark.createDataFrame(rows, "label string, lang string, tokens array<string>"), 2, by=["label", "lang"])
    asked = spark.createDataFrame([("fake", "x", "unseen", "a"), ("real", "x", "unseen", "a")], "label string, lang string, context string, word string")
    out = {(r["label"], r["lang"]): r["p"] for r in ngram_lm.probabilities(model, asked).collect()}
    assert out["fake", "x"] > out["real", "x"]


@pytest.mark.parametrize("max_broadcast", [1_000_000, 0])
def test_similar_against_brute_force(spark, corpus, max_broadcast):
    model = features.fit_terms(corpus).materialized()
    queries = spark.createDataFrame([(100, ["virus", "report"]), (101, ["nothing"])], "q int, terms array<string>")
    qw, cw = model.weights(queries, "q"), model.weights(corpus, "id")
    out = retrieve.similar(qw, cw, queries, corpus, "q", "id", 4, max_broadcast).orderBy("q", "rank").collect()
    vec = defaultdict(dict)
    for key, df in (("q", qw), ("id", cw)):
        for r in df.collect():
            vec[r[key]][r["term_id"]] = r["weight"]
    for q in (100, 101):
        cos = sorted(((-round(sum(w * vec[d].get(t, 0) for t, w in vec[q].items()), 6), d) for d in (1, 2, 3, 4, 5)))[:4]
        assert [(r["id"], r["similarity"]) for r in out if r["q"] == q] == [(d, -s) for s, d in cos]


def test_report_confusion_and_roc(spark):
    rows = [("real", "real", 0.9), ("real", "real", 0.8), ("real", "fake", 0.4), ("fake", "fake", 0.4), ("fake", "real", 0.7), ("fake", "fake", 0.1)]
    df = spark.createDataFrame(rows, "label string, prediction string, score double")
    cells = {(r["label"], r["prediction"]): r["n"] for r in evaluate.confusion(df, "label", CLASSES).collect()}
    assert cells == {("fake", "fake"): 2, ("fake", "real"): 1, ("real", "fake"): 1, ("real", "real"): 2}
    rep = {r["class"]: r for r in evaluate.class_report(df, "label", CLASSES).collect()}
    assert rep["real"]["precision"] == pytest.approx(2 / 3) and rep["real"]["support"] == 3
    assert rep["weighted avg"]["recall"] == pytest.approx(rep["accuracy"]["f1"])
    never = spark.createDataFrame([("fake", "fake")], "label string, prediction string")
    assert {r["class"]: r["f1"] for r in evaluate.class_report(never, "label", CLASSES).collect()}["real"] == 0
    pos = [s for y, _, s in rows if y == "real"]
    neg = [s for y, _, s in rows if y == "fake"]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / 9
    for buckets in (1, 3, 64):
        assert evaluate.roc_auc(df, F.col("label") == "real", "score", buckets).first()[0] == pytest.approx(want)
        curve = evaluate.roc_curve(df, F.col("label") == "real", "score", buckets).orderBy(F.desc("score")).collect()
        assert len(curve) == 5 and (curve[-1]["fpr"], curve[-1]["tpr"]) == (1, 1)


def test_sampling_and_profile(spark):
    df = spark.createDataFrame([(i, "a" if i < 6 else "b", "t" if i < 4 else f"t{i}") for i in range(10)], "id int, label string, text string")
    assert sampling.hash_sample(df, "id", 50).count() == 10
    assert [r["id"] for r in sampling.hash_sample(df, "id", 3).collect()] == [r["id"] for r in sampling.hash_sample(df, "id", 3).collect()]
    prof = {r["label"]: r for r in sampling.dataset_profile(df, "text", "label").collect()}
    assert prof["a"]["duplicate_rate"] == pytest.approx(0.5) and prof["b"]["share"] == pytest.approx(0.4)
    assert {r["id"] for r in sampling.drop_duplicates(df, "id", "text").collect()} == {0, 4, 5, 6, 7, 8, 9}
    priors = {r["label"]: r for r in sampling.class_priors(df, "label").collect()}
    assert priors["b"]["weight"] == pytest.approx(10 / (2 * 4))
    assert sampling.classes_of(df, "label") == ["a", "b"]
    decoded = spark.range(3).select(sampling.decode_labels(F.col("id"), CLASSES)).collect()
    assert [r[0] for r in decoded] == ["fake", "real", "2"]
