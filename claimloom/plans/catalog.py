"""Every query this engine answers, by name: ``(spark, folder) -> DataFrame``.

All of them read the whole tables of the folder. Doubles are rounded so that sums
taken in another order compare equal.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions import clean as cleaning
from claimloom.functions import stopwords, tokens
from claimloom.operators import (
    audit,
    evaluate,
    features,
    lexicon,
    linear,
    naive_bayes,
    neighbours,
    ngram_asked,
    ngram_lm,
    sampling,
    validate,
    vectors,
)
from claimloom.plans import experiments, scoring
from claimloom.plans.preprocess import SERVING, Preprocessing, fit_tokens, normalize_tokens, preprocess_requests, preprocess_tokens
from claimloom.session import broadcast_if_small, fresh_path, materialize
from claimloom.sources import files
from claimloom.sources.lake import Lake
from claimloom.sources.tables import documents, documents_with_labels, labelled_documents, read_table, spread
from claimloom.sources.uris import opened
from claimloom.streaming import jobs

CLASSES = scoring.CLASSES
QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def r6(c: Column | str, name: str | None = None) -> Column:
    column = F.col(c) if isinstance(c, str) else c
    return F.round(column, 6).alias(name or c)


def joined(c: Column | str) -> Column:
    return F.array_join(c, " ")


# ---------------------------------------------------------------- shared inputs


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return spread(read_table(spark, folder, "pages", "page_id", "html"), "page_id")


def turns(spark: SparkSession, folder: str) -> DataFrame:
    table = read_table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    return spread(table, "conv_id", "turn")


def cleaned_documents(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select("doc_id", cleaning.clean(F.col("text")).alias("cleaned_text"))


def with_terms(docs: DataFrame) -> DataFrame:
    """Clean and analyze: the vectorizer's view of a text table."""
    return docs.withColumn("terms", tokens.word_tokens(cleaning.clean(F.col("text"))))


def document_terms(spark: SparkSession, folder: str) -> DataFrame:
    return with_terms(documents(spark, folder)).select("doc_id", "terms")


def labelled_terms(spark: SparkSession, folder: str) -> DataFrame:
    return with_terms(labelled_documents(spark, folder)).select("doc_id", "label", "terms")


def split_terms(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.with_split(labelled_terms(spark, folder), "doc_id")


def nb_tokens(docs: DataFrame) -> naive_bayes.NaiveBayes:
    return naive_bayes.fit(features.doc_terms(docs, "label"), docs, "label", CLASSES)


def nb_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scored by a model trained on the labelled ones; texts are split into terms once."""
    docs = materialize(features.counted(with_terms(documents_with_labels(spark, folder)).select("doc_id", "label", "terms")), "nb-terms")
    model = nb_tokens(docs.where("label is not null")).materialized()
    return model.score(features.doc_terms(docs, "doc_id", outer=True), "doc_id")


def nb_test_scores(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, label, prediction, score`` of the test rows under a model of the training rows."""
    docs = materialize(features.counted(split_terms(spark, folder)), "split-terms")
    model = nb_tokens(docs.where(~F.col("is_test"))).materialized()
    test = features.doc_terms(docs.where("is_test"), "doc_id", "label", outer=True)
    # the margin: probabilities are 0 or 1 for all but a few. Nine places hide only the order in which terms were summed.
    margin = F.col("scores")[CLASSES[1]] - F.col("scores")[CLASSES[0]]
    return model.score(test, "doc_id", "label").select("doc_id", "label", "prediction", F.round(margin, 9).alias("score"))


# ---------------------------------------------------------------- text


@query
def clean_text(spark, folder):
    docs = documents(spark, folder).select(F.lit("documents").alias("source"), F.col("doc_id").alias("id"), "text")
    html = pages(spark, folder).select(F.lit("pages").alias("source"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    return docs.unionByName(html).select("source", "id", cleaning.clean(F.col("text")).alias("cleaned"))


@query
def strip_html(spark, folder):
    return pages(spark, folder).select("page_id", cleaning.strip_html(F.col("html")).alias("text"))


@query
def regex_tokens(spark, folder):
    found = tokens.regex_tokens(F.col("text"))
    return documents(spark, folder).select("doc_id", joined(found).alias("tokens"), F.size(found).cast("long").alias("n"))


@query
def treebank_tokens(spark, folder):
    found = tokens.treebank_tokens(F.col("cleaned_text"))
    return cleaned_documents(spark, folder).select("doc_id", joined(found).alias("tokens"), F.size(found).cast("long").alias("n"))


@query
def word_tokens(spark, folder):
    found = tokens.word_tokens(F.col("text"))
    return documents(spark, folder).select("doc_id", joined(found).alias("tokens"), F.size(found).cast("long").alias("n"))


def _without_stopwords(spark, folder, which):
    found = stopwords.drop_stopwords(tokens.regex_tokens(F.col("text")), which)
    return documents(spark, folder).select("doc_id", joined(found).alias("tokens"))


@query
def stopwords_standard(spark, folder):
    return _without_stopwords(spark, folder, "standard")


@query
def stopwords_domain(spark, folder):
    return _without_stopwords(spark, folder, "domain")


@query
def min_token_len(spark, folder):
    found = tokens.drop_short(tokens.regex_tokens(F.col("text")), 3)
    return documents(spark, folder).select("doc_id", joined(found).alias("tokens"))


def _vocab(spark, folder):
    return materialize(lexicon.vocabulary(document_terms(spark, folder), "terms"), "vocabulary")


@query
def lemma_noun(spark, folder):
    return lexicon.lemma_table(_vocab(spark, folder), "noun")


@query
def lemma_verb(spark, folder):
    return lexicon.lemma_table(_vocab(spark, folder), "verb")


@query
def preprocess(spark, folder):
    """The serving chain over the corpus: Treebank tokens, stop words, noun lemmas."""
    out = preprocess_tokens(cleaned_documents(spark, folder), "doc_id", SERVING)
    return out.select("doc_id", joined("tokens").alias("processed"))


@query
def preprocess_domain_min_len(spark, folder):
    out = preprocess_tokens(cleaned_documents(spark, folder), "doc_id", Preprocessing("domain", min_len=3))
    return out.select("doc_id", joined("tokens").alias("processed"))


@query
def preprocess_stem(spark, folder):
    out = preprocess_tokens(cleaned_documents(spark, folder), "doc_id", Preprocessing("standard", stem=True))
    return out.select("doc_id", joined("tokens").alias("processed"))


@query
def preprocess_requests_flags(spark, folder):
    """Conversation turns as requests that carry their own flags."""
    requests = turns(spark, folder).select(
        F.concat_ws("-", "conv_id", "turn").alias("request_id"),
        "text",
        (F.col("role") == "user").alias("remove_stopwords"),
        F.lit(False).alias("stem"),
        (F.col("turn") > 0).alias("lemma"),
        F.when(F.col("turn") > 1, 3).otherwise(0).alias("min_len"),
    )
    out = preprocess_requests(requests, "request_id")
    return out.select("request_id", joined("tokens").alias("tokens"), F.size("tokens").cast("long").alias("n"))


@query
def preprocess_requests_corpus(spark, folder):
    """Requests whose lemmas are words of the corpus, so that a request's tokens don't depend on its neighbours."""
    requests = turns(spark, folder).select(
        F.concat_ws("-", "conv_id", "turn").alias("request_id"), "text", (F.col("role") == "user").alias("remove_stopwords"),
        (F.col("turn") % 3 == 2).alias("stem"), (F.col("turn") % 3 != 0).alias("lemma"), F.lit(0).alias("min_len"),
    )
    _, words = fit_tokens(cleaned_documents(spark, folder), "doc_id", SERVING)
    out = preprocess_requests(requests, "request_id", words)
    return out.select("request_id", joined("tokens").alias("tokens"))


@query
def ngrams(spark, folder):
    """Bigrams of every document with padding, in place."""
    grams = tokens.ngrams(tokens.word_tokens(F.col("text")), 2)
    texts = F.transform(grams, lambda g: F.concat_ws(" ", g["context"], g["word"]))
    return documents(spark, folder).select("doc_id", F.size(grams).cast("long").alias("n"), F.array_join(texts, "|").alias("grams"))


@query
def stem_vocab(spark, folder):
    return lexicon.stem_table(_vocab(spark, folder))


@query
def stem_vs_lemma(spark, folder):
    return lexicon.stem_vs_lemma(_vocab(spark, folder))


@query
def vocabulary_reduction(spark, folder):
    return lexicon.vocabulary_reduction(lexicon.stem_vs_lemma(_vocab(spark, folder)))


# ---------------------------------------------------------------- audits


@query
def noise_audit(spark, folder):
    """A sampling report over raw pages: the seeded sample size is the feature."""
    out = audit.noise_audit(pages(spark, folder), "page_id", "html")
    return out.select(
        "page_id", F.md5("cleaned_text").alias("cleaned_md5"), F.col("original_len").cast("long").alias("original_len"),
        F.col("cleaned_len").cast("long").alias("cleaned_len"),
    )


@query
def noise_summary(spark, folder):
    every = pages(spark, folder).select(
        F.length("html").alias("original_len"), F.length(cleaning.clean(F.col("html"))).alias("cleaned_len")
    )
    return audit.noise_summary(every).select(r6("noise_reduction"))


@query
def tokenizer_compare(spark, folder):
    counts = audit.tokenizer_counts(cleaned_documents(spark, folder), "doc_id", "cleaned_text", None)
    return counts.select("doc_id", "preview", *[F.col(f"{m}_count").cast("long").alias(f"{m}_count") for m in ("treebank", "regex", "whitespace")])


@query
def tokenizer_summary(spark, folder):
    counts = audit.tokenizer_counts(cleaned_documents(spark, folder), "doc_id", "cleaned_text")
    return audit.tokenizer_summary(counts).select(*[r6(f"avg_{m}") for m in ("treebank", "regex", "whitespace")])


@query
def oov_rate(spark, folder):
    """Conversation words missing from the vocabulary of the documents."""
    words = turns(spark, folder).select(
        F.concat_ws("-", "conv_id", "turn").alias("request_id"), tokens.regex_tokens(F.col("text")).alias("tokens")
    )
    known = materialize(lexicon.vocabulary(documents(spark, folder).select(tokens.whitespace_tokens(F.lower("text")).alias("tokens"))), "vocabulary")
    return audit.oov_rate(words, known, "request_id").select("request_id", "tokens", "oov", r6("oov_rate"))


# ---------------------------------------------------------------- features


@query
def top_vocab(spark, folder):
    out = features.top_vocabulary(document_terms(spark, folder))
    return out.select(F.col("term_id").cast("long").alias("term_id"), "term", "tf", "df")


@query
def bow_counts(spark, folder):
    docs = materialize(features.counted(document_terms(spark, folder)), "terms")
    return features.fit_terms(docs).counts(docs, "doc_id").select("doc_id", "term", "tf")


@query
def bow_sparsity(spark, folder):
    docs = materialize(features.counted(document_terms(spark, folder)), "terms")
    model = features.fit_terms(docs)
    out = features.sparsity(model.counts(docs, "doc_id"), docs, model.vocabulary)
    return out.withColumn("sparsity_percentage", F.round("sparsity_percentage", 6))


def _tfidf(spark, folder, variant):
    docs = materialize(features.counted(document_terms(spark, folder)), "terms")
    model = features.fit_terms(docs, variant=variant)
    return model.weights(docs, "doc_id").select("doc_id", "term", r6("weight"))


@query
def tfidf_smooth(spark, folder):
    return _tfidf(spark, folder, "smooth")


@query
def tfidf_sublinear(spark, folder):
    return _tfidf(spark, folder, "sublinear")


@query
def tfidf_standard(spark, folder):
    return _tfidf(spark, folder, "standard")


@query
def tfidf_stats(spark, folder):
    docs = materialize(features.counted(document_terms(spark, folder)), "terms")
    model = features.fit_terms(docs)
    out = features.weight_stats(model.weights(docs, "doc_id"), docs, model.vocabulary)
    return out.select(r6("max_tfidf_value"), F.round("mean_tfidf_value", 9).alias("mean_tfidf_value"))


@query
def discriminative_terms(spark, folder):
    docs = materialize(features.counted(labelled_terms(spark, folder)), "terms")
    weights = features.fit_terms(docs).weights(docs, "doc_id")
    out = features.discriminative_terms(weights, docs, "doc_id", "label")
    return out.select("label", F.col("rank").cast("long").alias("rank"), "term", "mean_weight")


# ---------------------------------------------------------------- language model


def _lm_docs(spark, folder):
    return document_terms(spark, folder).withColumnRenamed("terms", "tokens")


def _trigrams(spark, folder):
    return ngram_lm.ngram_counts(_lm_docs(spark, folder), 3)


@query
def ngram_counts(spark, folder):
    return _trigrams(spark, folder).select(F.col("n").cast("long").alias("n"), "context", "word", "cnt")


@query
def ngram_context_counts(spark, folder):
    out = ngram_lm.context_counts(_trigrams(spark, folder))
    return out.select(F.col("n").cast("long").alias("n"), "context", "total", "followers")


@query
def ngram_continuations(spark, folder):
    out = ngram_lm.continuation_counts(_trigrams(spark, folder))
    return out.select(F.col("n").cast("long").alias("n"), "word", "continuations")


@query
def lm_vocabulary(spark, folder):
    return ngram_lm.lm_vocabulary(_lm_docs(spark, folder), 3)


@query
def top_ngrams_by_class(spark, folder):
    counts = ngram_lm.ngram_counts(labelled_terms(spark, folder), 3, "label", tokens="terms")
    # n-grams of words alone: no word is a mark
    out = ngram_lm.top_ngrams(counts.where("word != '</s>' and not startswith(context, '<s>')"), "label")
    return out.select("label", F.col("n").cast("long").alias("n"), F.col("rank").cast("long").alias("rank"), "ngram", "cnt")


def _turn_tokens(spark, folder):
    return turns(spark, folder).select(
        F.concat_ws("-", "conv_id", "turn").alias("request_id"),
        tokens.word_tokens(cleaning.clean(F.col("text"))).alias("tokens"),
    )


def _model_for(spark, folder, asked):
    """The trigram model of the documents, as far as ``asked`` needs it."""
    return ngram_asked.fit_for(materialize(_lm_docs(spark, folder), "lm-tokens"), asked, 3)


@query
def kn_prob(spark, folder):
    """Trigram model of the documents, asked for every n-gram of the conversations."""
    grams = materialize(ngram_lm.explode_ngrams(_turn_tokens(spark, folder), 3, orders=[3]).select("context", "word").distinct(), "lm-asked")
    out = ngram_lm.probabilities(_model_for(spark, folder, grams), grams)
    return out.select("context", "word", F.col("level").cast("long").alias("level"), F.round("p", 9).alias("p"))


@query
def kn_perplexity(spark, folder):
    counted = ngram_lm.positions(_turn_tokens(spark, folder), 3)
    out = ngram_lm.single_row(ngram_lm.perplexity_of(_model_for(spark, folder, counted), counted))
    return out.select("positions", F.round("perplexity", 4).alias("perplexity"))


@query
def kn_perplexity_by_text(spark, folder):
    counted = ngram_lm.positions(_turn_tokens(spark, folder), 3, "request_id")
    out = ngram_lm.perplexity_of(_model_for(spark, folder, counted), counted, "request_id")
    return out.select("request_id", "positions", F.round("perplexity", 4).alias("perplexity"))


def _last_contexts(spark, folder):
    contexts = _turn_tokens(spark, folder).select(ngram_lm.fit_context(F.col("tokens"), 3).alias("context")).distinct()
    return materialize(contexts, "lm-last-contexts")


@query
def kn_next_word(spark, folder):
    """The five likeliest words after the last two words of every conversation turn."""
    asked = _last_contexts(spark, folder)
    out = ngram_lm.next_words(_model_for(spark, folder, asked), asked)
    return out.select("context", F.col("rank").cast("long").alias("rank"), "word", "p")


@query
def kn_sample_word(spark, folder):
    asked = _last_contexts(spark, folder)
    return ngram_lm.sample_next(_model_for(spark, folder, asked), asked)


@query
def lm_classify(spark, folder):
    """Held-out documents classified by the class model that is least surprised."""
    docs = materialize(split_terms(spark, folder).withColumnRenamed("terms", "tokens"), "split-tokens")
    counted = ngram_lm.positions(docs.where("is_test"), 3, "doc_id")
    model = ngram_asked.fit_for(docs.where(~F.col("is_test")), counted, 3, by=["label"])
    out = ngram_lm.least_surprised(ngram_lm.perplexity_of(model, counted, "doc_id"), "doc_id", "label")
    return out.select("doc_id", "prediction", F.round("perplexity", 4).alias("perplexity"))


# ---------------------------------------------------------------- Naive Bayes


@query
def class_priors(spark, folder):
    out = sampling.class_priors(labelled_documents(spark, folder), "label")
    return out.select("label", "n", r6("prior"), r6("log_prior"))


@query
def class_weights(spark, folder):
    out = sampling.class_priors(labelled_documents(spark, folder), "label")
    return out.select("label", "n", r6("weight"))


@query
def nb_train_tokens(spark, folder):
    model = nb_tokens(materialize(labelled_terms(spark, folder), "nb-terms")).materialized()
    return model.term_table().select("term", "class", "cnt", r6("ll"))


@query
def nb_class_table(spark, folder):
    return nb_tokens(materialize(labelled_terms(spark, folder), "nb-terms")).materialized().class_table().select("class", r6("log_prior"), r6("default_ll"))


def _nb_weights(spark, folder):
    docs = materialize(features.counted(labelled_terms(spark, folder)), "nb-terms")
    model = features.fit_terms(docs).materialized()
    rows = model.weights(docs, "doc_id").join(docs.select("doc_id", "label"), "doc_id")
    # every column of the fitted matrix holds at least one value, so the terms seen are its columns
    return model, naive_bayes.fit(rows, docs, "label", CLASSES, weight="weight")


@query
def nb_train_tfidf(spark, folder):
    _, nb = _nb_weights(spark, folder)
    return nb.term_table().select("term", "class", r6("cnt", "total_weight"), r6("ll"))


@query
def nb_score(spark, folder):
    out = nb_scored(spark, folder).select("doc_id", F.explode("scores").alias("class", "score"))
    return out.select("doc_id", "class", F.round("score", 4).alias("score"))


@query
def nb_proba(spark, folder):
    out = nb_scored(spark, folder).select("doc_id", F.explode("probabilities").alias("class", "p"))
    return out.select("doc_id", "class", r6("p"))


@query
def nb_predict(spark, folder):
    return nb_scored(spark, folder).select("doc_id", "prediction", r6("confidence"))


def _alpha_rows(spark, folder):
    docs = materialize(features.counted(split_terms(spark, folder)), "split-terms")
    model = nb_tokens(docs.where(~F.col("is_test"))).materialized()
    test = features.doc_terms(docs.where("is_test"), "doc_id", "label", outer=True)
    return naive_bayes.alpha_sweep(model, test, "doc_id", "label")


@query
def nb_alpha_sweep(spark, folder):
    out = _alpha_rows(spark, folder).groupBy("alpha").agg(evaluate.accuracy(None, "label").alias("accuracy"))
    return out.select("alpha", r6("accuracy"))


def _claim_model(spark, folder):
    return scoring.fit_claims(labelled_documents(spark, folder), "doc_id")


def _classified(spark, folder):
    model = _claim_model(spark, folder)
    requests = turns(spark, folder).select(F.concat_ws("-", "conv_id", "turn").alias("doc_id"), "text")
    return model, requests


@query
def classify_nb(spark, folder):
    """Valid conversation turns as requests to a Naive Bayes on TF-IDF weights."""
    model, requests = _classified(spark, folder)
    valid, _ = validate.split_valid(validate.with_reason(requests, validate.text_reason(F.col("text"), "classify")))
    out = scoring.classify(model, valid)
    return out.select(
        F.col("doc_id").alias("request_id"),
        "prediction",
        r6("confidence"),
        r6(F.col("class_probabilities")["fake"], "p_fake"),
        r6(F.col("class_probabilities")["real"], "p_real"),
    )


@query
def nb_top_features(spark, folder):
    model, requests = _classified(spark, folder)
    out = scoring.classify(model, requests).select("doc_id", F.posexplode("top_contributing_features").alias("pos", "f"))
    return out.select(
        F.col("doc_id").alias("request_id"), (F.col("pos") + 1).cast("long").alias("rank"), F.col("f.term").alias("term"),
        r6(F.col("f.weight"), "weight"),
    )


@query
def classify_batch_nb(spark, folder):
    model, requests = _classified(spark, folder)
    return scoring.classify_batch(model, requests).select(F.col("doc_id").alias("request_id"), "text", "prediction")


@query
def classify_batch(spark, folder):
    """Conversations as batches of 1 to 100 texts: their sizes and the predictions in order of the turns."""
    model = _claim_model(spark, folder)
    rows = turns(spark, folder).withColumn("doc_id", F.concat_ws("-", "conv_id", "turn"))
    results = scoring.classify_batch(model, rows.select("doc_id", "text"))
    out = scoring.batches(rows, results, "conv_id", "turn", "doc_id")
    predictions = F.array_join(F.transform("results", lambda r: r["prediction"]), ",")
    return out.select("conv_id", "batch_size", F.coalesce(predictions, F.lit("")).alias("predictions"), F.coalesce("reject_reason", F.lit("")).alias("reason"))


@query
def classify_lr(spark, folder):
    """Valid conversation turns as requests to a logistic regression on TF-IDF weights, with the five terms that count most."""
    train = materialize(labelled_terms(spark, folder), "lr-train")
    term_model = features.fit_terms(train).materialized()
    pipeline = scoring.linear_pipeline(train, term_model=term_model)
    requests = turns(spark, folder).select(F.concat_ws("-", "conv_id", "turn").alias("request_id"), "text")
    valid, _ = validate.split_valid(validate.with_reason(requests, validate.text_reason(F.col("text"), "classify")))
    out = scoring.classify_linear(pipeline, term_model.vocabulary, materialize(with_terms(valid), "lr-requests"), "request_id")
    features_of = F.transform("top_contributing_features", lambda t: F.concat_ws(":", t["term"], F.round(t["weight"], 6)))
    return out.select(
        "request_id", "prediction", r6("confidence"), r6(F.col("class_probabilities")["fake"], "p_fake"), r6(F.col("class_probabilities")["real"], "p_real"),
        F.coalesce(joined(features_of), F.lit("")).alias("top_features"),
    )


# ---------------------------------------------------------------- retrieval


@query
def similar_claims(spark, folder):
    """The five documents most similar to every benchmark text."""
    queries = read_table(spark, folder, "benchmark", "item_id", "text")
    out = materialize(scoring.retrieve(documents(spark, folder), queries, "doc_id", "item_id"), "similar")
    out = broadcast_if_small(out)  # five rows a query; the texts stay where they are
    labels = documents_with_labels(spark, folder).select("doc_id", "label", cleaning.preview(F.col("text")).alias("text"))
    return labels.join(out, "doc_id").select(
        "item_id", F.col("rank").cast("long").alias("rank"), "doc_id", "text", F.coalesce("label", F.lit("")).alias("label"), "similarity"
    )


@query
def similar_approx(spark, folder):
    """Documents at least half alike, found by hash bands, for every document whose id is divisible by 50."""
    docs = documents(spark, folder)
    asked = docs.where("doc_id % 50 = 0").select(F.col("doc_id").alias("request_id"), "text")
    out = scoring.retrieve(docs, materialize(asked, "requests"), "doc_id", "request_id", approx=0.5)
    return out.select("request_id", F.col("rank").cast("long").alias("rank"), "doc_id", "similarity")


@query
def similar_claims_top_k(spark, folder):
    """Conversation turns as requests that each ask for their own number of claims, 1 to 20; others are rejected."""
    asked = F.concat_ws("-", "conv_id", "turn").alias("request_id"), "text", ((F.col("turn") + 1) * 4).alias("top_k")
    requests = turns(spark, folder).select(*asked)
    reason = F.coalesce(validate.text_reason(F.col("text"), "retrieve"), validate.top_k_reason(F.col("top_k")))
    valid, _ = validate.split_valid(validate.with_reason(requests, reason))
    out = scoring.retrieve(documents(spark, folder), materialize(valid, "requests"), "doc_id", "request_id", "top_k")
    return out.select("request_id", F.col("rank").cast("long").alias("rank"), "doc_id", "similarity")


# ---------------------------------------------------------------- sampling, evaluation


@query
def hash_split(spark, folder):
    return sampling.with_split(read_table(spark, folder, "documents", "doc_id"), "doc_id")


@query
def hash_sample(spark, folder):
    return sampling.hash_sample(read_table(spark, folder, "documents", "doc_id", "lang"), "doc_id", 200)


@query
def head_rows(spark, folder):
    return sampling.head(read_table(spark, folder, "documents", "doc_id", "source"), "doc_id", 1000)


@query
def label_encode(spark, folder):
    labels = documents_with_labels(spark, folder).select("doc_id", "label")
    out = sampling.encode_labels(labels, "label", CLASSES)
    return out.select("doc_id", F.col("target").cast("long").alias("target"), sampling.decode_labels(F.col("target"), CLASSES).alias("label"))


@query
def validate_requests(spark, folder):
    """Turns as classify and preprocess requests, and whole conversations as batches."""
    rows = turns(spark, folder)
    single = rows.select(
        F.concat_ws("-", "conv_id", "turn").alias("request_id"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(k).alias("kind"), validate.text_reason(F.col("text"), k).alias("reason"))
                    for k in ("preprocess", "classify", "retrieve")
                ],
                F.struct(F.lit("top_k").alias("kind"), validate.top_k_reason((F.col("turn") + 1) * 4).alias("reason")),
            )
        ),
    )
    sizes = rows.groupBy(F.col("conv_id").cast("string").alias("request_id")).agg(F.count("*").alias("n"))
    batch = sizes.select("request_id", F.lit("batch").alias("kind"), validate.batch_size_reason(F.col("n")).alias("reason"))
    return single.unionByName(batch).select("request_id", "kind", F.coalesce("reason", F.lit("")).alias("reason"))


@query
def confusion(spark, folder):
    return evaluate.confusion(nb_test_scores(spark, folder), "label", CLASSES)


@query
def class_report(spark, folder):
    out = evaluate.class_report(nb_test_scores(spark, folder), "label", CLASSES)
    return out.select("class", r6("precision"), r6("recall"), r6("f1"), "support")


@query
def accuracy(spark, folder):
    return nb_test_scores(spark, folder).agg(r6(evaluate.accuracy(None, "label"), "accuracy"))


@query
def roc_curve(spark, folder):
    scores = materialize(nb_test_scores(spark, folder), "scores")
    out = evaluate.roc_curve(scores, F.col("label") == CLASSES[1], "score")
    return out.select(r6("score"), r6("fpr"), r6("tpr"))


@query
def roc_auc(spark, folder):
    scores = materialize(nb_test_scores(spark, folder), "scores")
    return evaluate.roc_auc(scores, F.col("label") == CLASSES[1], "score").select(r6("roc_auc"))


@query
def misclassified_buckets(spark, folder):
    docs = materialize(split_terms(spark, folder), "split-terms")
    train, test = docs.where(~F.col("is_test")), docs.where("is_test")
    scored = nb_tokens(train).score(features.doc_terms(test, "doc_id", "label", outer=True), "doc_id", "label")
    rates = audit.oov_rate(test, lexicon.vocabulary(train, "terms"), "doc_id", "terms")
    table = scored.join(rates, "doc_id").join(documents(spark, folder), "doc_id")
    out = evaluate.misclassified(table.withColumn("oov_rate", F.round("oov_rate", 6)), "doc_id", "label", "text", "oov_rate")
    return out.select("doc_id", "label", "prediction", "oov_rate", "bucket")


@query
def dataset_profile(spark, folder):
    docs = read_table(spark, folder, "documents", "doc_id", "text", "lang")
    out = sampling.dataset_profile(docs, "text", "lang")
    return out.select("lang", "documents", "distinct_texts", r6("share"), r6("duplicate_rate"))


@query
def dedupe_exact(spark, folder):
    docs = cleaned_documents(spark, folder)
    return sampling.drop_duplicates(docs, "doc_id", "cleaned_text").select("doc_id", F.md5("cleaned_text").alias("text_md5"))


# ---------------------------------------------------------------- experiments


MODEL = "claims-nb"


def sweep_runs(spark, folder) -> DataFrame:
    """The smoothing sweep as a run log: one run per alpha with its test metrics."""
    rows = _alpha_rows(spark, folder)
    metrics = evaluate.summary_metrics(rows, "label", CLASSES, ["alpha"])
    names = [c for c in metrics.columns if c != "alpha"]
    return experiments.run_record(
        metrics,
        F.concat(F.lit("nb-"), F.col("alpha").cast("string")),
        F.concat(F.lit("Alpha "), F.col("alpha").cast("string")),
        F.create_map(
            F.lit("alpha"), F.col("alpha").cast("string"), F.lit("remove_stopwords"), F.lit("False"),
            F.lit("smoothed"), (F.col("alpha") >= 0.5).cast("string"),
        ),
        F.create_map(*[x for m in names for x in (F.lit(m), F.round(m, 6))]),
        parent=F.lit("nb-sweep"),
        step=F.array_position(F.array(*map(F.lit, naive_bayes.ALPHAS)), F.col("alpha")).cast("int") - 1,
        has_model=True,  # the counts of the training rows with the run's alpha are the model
    )


def _registry(runs):
    return experiments.registry_from_runs(runs, MODEL, 2)


@query
def run_flatten(spark, folder):
    out = experiments.flatten_runs(sweep_runs(spark, folder), ["remove_stopwords", "smoothed"], ["alpha"], ["f1_weighted", "accuracy"])
    return out.select(
        "run_id", F.col("remove_stopwords").cast("long").alias("remove_stopwords"), F.col("smoothed").cast("long").alias("smoothed"),
        "alpha", "f1_weighted", "accuracy",
    )


@query
def best_run(spark, folder):
    out = experiments.best_run(sweep_runs(spark, folder))
    return out.select("run_id", experiments.metric("f1_weighted").alias("f1_weighted"))


@query
def promotion(spark, folder):
    runs = materialize(sweep_runs(spark, folder), "runs")
    out = experiments.promotion(runs, _registry(runs), MODEL)
    return out.select("model_name", F.col("version").cast("long").alias("version"), "stage", "run_id")


@query
def model_history(spark, folder):
    runs = materialize(sweep_runs(spark, folder), "runs")
    out = experiments.model_history(_registry(runs), runs)
    return out.select("model_name", F.col("version").cast("long").alias("version"), "stage", "f1_weighted", "accuracy")


@query
def run_log(spark, folder):
    """Append the sweep to a log, read it back, and list its metrics one per row."""
    path = fresh_path(spark, "run-log")
    experiments.log_runs(sweep_runs(spark, folder), path)
    out = experiments.stepped_metrics(experiments.read_runs(spark, path))
    return out.select("run_id", "metric", "value")


def _nested_log(spark, folder) -> DataFrame:
    """The sweep as runs nested in one, the sweep itself nested in a project, logged in two appends and read back."""
    path = fresh_path(spark, "run-log")
    project = experiments.new_run(spark, "project", {}, {}, run_id="project")
    experiments.log_runs(project.unionByName(experiments.new_run(spark, "sweep", {"model": "nb"}, {}, parent="project", run_id="nb-sweep")), path)
    experiments.log_runs(sweep_runs(spark, folder), path)
    return experiments.read_runs(spark, path)


@query
def run_steps(spark, folder):
    """Logged values with their steps and the runs that theirs are nested in."""
    out = experiments.nested_metrics(_nested_log(spark, folder))
    return out.select("run_id", "parent_run_id", F.col("step").cast("long").alias("step"), "metric", "value")


@query
def run_summary(spark, folder):
    """For a run that others are nested in, at any depth: their number and their best, worst and last values."""
    return experiments.nested_summary(_nested_log(spark, folder))


@query
def ablation(spark, folder):
    runs = experiments.ablation(labelled_documents(spark, folder), "doc_id")
    return runs.select(
        "run_name",
        *[F.round(experiments.metric(m), 6).alias(m) for m in ("accuracy", "f1_weighted", "f1_fake", "f1_real", "roc_auc")],
        experiments.metric("training_time_seconds").alias("training_time_seconds"),
    )


# ---------------------------------------------------------------- files and lake


@query
def detect_text_column(spark, folder):
    """Mean text length per column of the pages, and the column that holds the text."""
    table = read_table(spark, folder, "pages")
    chosen = files.text_column(table)
    out = files.mean_lengths(table)
    return out.select("column", r6("mean_length"), (F.col("column") == chosen).alias("chosen"))


def _written_lake(spark, folder) -> Lake:
    """A lake with two processed tables and one of vectors, each with a version made from its greatest id."""
    lake = Lake(spark, fresh_path(spark, "lake"))
    for table, key, columns in (("documents", "doc_id", ("lang", "text")), ("pages", "page_id", ("html",)), ("embeddings", "vec_id", ("embedding",))):
        rows = read_table(spark, folder, table, key, *columns)
        version = f"2024{rows.agg(F.max(key)).first()[0] or 0:010d}"
        put = lake.put_vectors if table == "embeddings" else lake.put_table
        put(rows, table, {"key": key, "rows": -1}, version)
    return lake


@query
def list_versions(spark, folder):
    out = _written_lake(spark, folder).list_versions()
    return out.select("layer", F.size("versions").cast("long").alias("n"), F.array_join("versions", ",").alias("versions"))


@query
def metadata_json(spark, folder):
    """Metadata as JSON texts, read back field by field; the lake's own keys win over the caller's."""
    out = _written_lake(spark, folder).metadata_json()
    fields = [F.get_json_object("metadata", f"$.{k}").alias(k) for k in ("layer", "name", "version", "key", "rows", "columns")]
    return out.select(*fields)


@query
def lake_roundtrip(spark, folder):
    """Cleaned documents written to the lake as two versions and read back as one table."""
    lake = Lake(spark, fresh_path(spark, "lake"))
    docs = cleaned_documents(spark, folder)
    lake.put_table(docs, "claims", {"step": "cleaned"}, "20240101000000")
    lake.put_table(docs.withColumn("n", F.length("cleaned_text")), "claims_sized", None, "20240102000000")
    out = lake.fetch("processed")
    return out.groupBy("artifact", "version").agg(
        F.count("*").alias("rows"), F.countDistinct(F.md5("cleaned_text")).alias("texts"), F.sum(F.col("n").cast("long")).alias("chars")
    ).select("artifact", "version", "rows", "texts", F.coalesce("chars", F.lit(0)).alias("chars"))


RAW_ROWS = 40_000


@query
def ingest_incremental(spark, folder):
    """Documents written as raw CSV, cleaned by the file job, and skipped when it runs again."""
    root = fresh_path(spark, "ingest")
    docs = read_table(spark, folder, "documents", "doc_id", "text", "lang")
    docs = docs.select("doc_id", F.col("text").alias("tweet"), "lang")
    # a folder per language, a file for at most RAW_ROWS of its rows: a file is read by one task
    lot = F.pmod(F.xxhash64("doc_id", "tweet"), F.lit(-(-docs.count() // RAW_ROWS) or 1))
    writer = docs.repartition("lang", lot).write.partitionBy("lang").option("maxRecordsPerFile", RAW_ROWS)
    writer.option("header", True).option("escape", '"').csv(f"{root}/raw")
    first = files.clean_folder(spark, f"{root}/raw", f"{root}/processed").withColumn("run", F.lit(1))
    second = files.clean_folder(spark, f"{root}/raw", f"{root}/processed").withColumn("run", F.lit(2))
    languages = F.countDistinct(F.regexp_extract("path", "/lang=([^/]*)/", 1))
    return first.unionByName(second).groupBy("run", "status").agg(languages.alias("files"))


@query
def ingest_cleaned(spark, folder):
    """The cleaned texts the file job produces, through CSV and back."""
    root = fresh_path(spark, "ingest")
    docs = documents(spark, folder).select("doc_id", F.col("text").alias("tweet"))
    docs.write.option("header", True).option("escape", '"').csv(f"{root}/raw")
    files.clean_folder(spark, f"{root}/raw", f"{root}/processed").count()
    out = files.read_cleaned(spark, f"{root}/processed")
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "cleaned_text")


def _broken_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, tweet`` as they stand in a raw file: whole texts in quotes, and every tenth row with fields too many."""
    quoted = F.concat(F.lit('"'), F.replace(F.coalesce("text", F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    return docs.select("doc_id", F.when(F.col("doc_id") % 10 == 0, F.concat(quoted, F.lit(",more,fields"))).otherwise(quoted).alias("tweet"))


def _write_raw(rows: DataFrame, path: str) -> None:
    """Rows as they are, in files that each begin with a header. A task that runs again writes its file again."""

    def lines(batches):
        n, (store, name) = TaskContext.get().partitionId(), opened(path)
        store.create_dir(name, recursive=True)
        with store.open_output_stream(f"{name}/part-{n}.csv") as file:
            file.write(b"doc_id,tweet\n")
            for batch in batches:
                for line in batch["value"].to_pylist():
                    file.write(line.encode() + b"\n")
        yield pa.RecordBatch.from_arrays([pa.array([n])], ["part"])

    rows.select(F.concat_ws(",", F.col("doc_id").cast("string"), "tweet").alias("value")).mapInArrow(lines, "part long").count()


@query
def ingest_malformed(spark, folder):
    """Raw files of the documents in which every tenth row has too many fields: those rows are skipped, the others are cleaned."""
    root = fresh_path(spark, "ingest")
    _write_raw(_broken_rows(documents(spark, folder)), f"{root}/raw")
    files.clean_folder(spark, f"{root}/raw", f"{root}/processed").count()
    out = files.read_cleaned(spark, f"{root}/processed")
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "cleaned_text")


@query
def lake_raw(spark, folder):
    """Whole texts of the documents as text files, a file per source and thousand ids, kept in the raw layer byte for byte."""
    root = fresh_path(spark, "lake")
    docs = read_table(spark, folder, "documents", "doc_id", "source", "text").withColumn("lot", F.floor(F.col("doc_id") / 1000))
    lots = docs.repartition("source", "lot").sortWithinPartitions("source", "lot", "doc_id")
    lots.select("source", "lot", F.coalesce("text", F.lit("")).alias("value")).write.partitionBy("source", "lot").text(f"{root}/in/texts")
    lake = Lake(spark, f"{root}/lake")
    lake.put_raw(f"{root}/in/texts", {"from": "documents"}, "texts", "20240101000000")
    rows = lake.fetch("raw").where(F.col("path").contains("/part-"))
    return rows.select(
        F.regexp_extract("path", "/source=([^/]*)/", 1).alias("source"), F.regexp_extract("path", "/lot=([0-9]*)/", 1).cast("long").alias("lot"), "at",
        F.octet_length("content").cast("long").alias("bytes"), F.md5("content").alias("digest"),
    )


@query
def lake_vectors(spark, folder):
    """Vectors stored in the embeddings layer and read back, a row per value."""
    lake = Lake(spark, fresh_path(spark, "lake"))
    lake.put_vectors(read_table(spark, folder, "embeddings", "vec_id", "embedding"), "vectors", None, "20240101000000")
    rows = lake.fetch("embeddings").select("vec_id", "artifact", "version", F.posexplode("embedding").alias("at", "value"))
    return rows.select("vec_id", "artifact", "version", F.col("at").cast("long").alias("at"), F.col("value").cast("double").alias("value"))


@query
def vocabulary_export(spark, folder):
    """The vocabulary written as CSV and read back, as the words and their places in it."""
    path = fresh_path(spark, "vocabulary")
    files.write_vocabulary(features.top_vocabulary(document_terms(spark, folder)), path)
    words = spark.read.schema("word string").option("header", True).csv(path)
    return words.select("word", F.length("word").cast("long").alias("length"))


@query
def report_export(spark, folder):
    """The class report written as CSV and read back."""
    path = fresh_path(spark, "report")
    files.write_report(class_report(spark, folder), path)
    return spark.read.schema("class string, precision double, recall double, f1 double, support long").option("header", True).csv(path)


@query
def normalized_tokens(spark, folder):
    """Domain stop words removed, then noun lemmas, on regex tokens of the cleaned documents."""
    docs = cleaned_documents(spark, folder).select("doc_id", tokens.word_tokens(F.col("cleaned_text")).alias("tokens"))
    out = normalize_tokens(docs, "doc_id", "tokens")
    return out.select("doc_id", joined("tokens").alias("tokens"))


@query
def stopword_sets(spark, folder):
    """How often each word of the standard and the domain list stands in the documents; the domain list is made by set operations."""
    table = lambda words: spark.createDataFrame([(w,) for w in sorted(words)], "word string")
    standard = stopwords.stopword_table(spark, "standard")
    domain = stopwords.domain_table(standard, table(stopwords.KEPT), table(stopwords.NEWSROOM))
    lists = standard.withColumn("list", F.lit("standard")).unionByName(domain.withColumn("list", F.lit("domain")))
    found = document_terms(spark, folder).select(F.explode("terms").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return lists.join(found, "word", "left").select("list", "word", F.coalesce("n", F.lit(0)).alias("n"))


# ---------------------------------------------------------------- linear models and vectors


def _linear_inputs(spark, folder, max_features=features.MAX_FEATURES):
    docs = materialize(split_terms(spark, folder), "linear-terms")
    model = features.fit_terms(docs.where(~F.col("is_test")), max_features).materialized()
    table, _ = scoring.vector_table(docs, model, "label")
    table = table.select("doc_id", "label", "is_test", "features", "target").persist()
    return docs, model, table


def _importances(spark, folder):
    docs, model, table = _linear_inputs(spark, folder)
    models = linear.train_variants(table.where(~F.col("is_test")))
    return docs, table, models, linear.all_importances(models, model.vocabulary)


@query
def lr_variants(spark, folder):
    """Test metrics of the three penalties."""
    _, table, models, _ = _importances(spark, folder)
    out = None
    for variant, model in models.items():
        part = experiments.score_vectors(model, table.where("is_test"), "doc_id", "label").withColumn("variant", F.lit(variant))
        out = part if out is None else out.unionByName(part)
    metrics = evaluate.summary_metrics(out, "label", CLASSES, ["variant"])
    return metrics.select("variant", r6("accuracy"), r6("f1_weighted"), r6("f1_fake"), r6("f1_real"))


@query
def lr_importance(spark, folder):
    _, _, _, table = _importances(spark, folder)
    return table.select("variant", "word", r6("coefficient"), r6("abs_val"))


@query
def lr_weight_summary(spark, folder):
    _, _, _, table = _importances(spark, folder)
    return linear.weight_summary(table).select("variant", "nonzero_weights", r6("max_weight"))


@query
def lr_top_features(spark, folder):
    docs, _, _, table = _importances(spark, folder)
    l2 = table.where("variant = 'l2'").drop("variant")
    out = linear.top_features(features.doc_terms(docs, "doc_id"), l2, "doc_id")
    return out.select("doc_id", "rank", "term", r6("coefficient"))


@query
def lr_weighted(spark, folder):
    """The L2 model with balanced class weights."""
    _, _, table = _linear_inputs(spark, folder)
    weights = sampling.class_priors(table.where(~F.col("is_test")), "label").select("label", "weight")
    weighted = table.join(F.broadcast(weights), "label")
    model = linear.train_variants(weighted.where(~F.col("is_test")), variants=("l2",), weight="weight")["l2"]
    out = experiments.score_vectors(model, table.where("is_test"), "label")
    return evaluate.class_report(out, "label", CLASSES).select("class", r6("precision"), r6("recall"), r6("f1"), "support")


def _poly_scores(spark, folder, degrees):
    _, _, table = _linear_inputs(spark, folder)
    out = None
    for degree in degrees:
        model = linear.train_polynomial(table.where(~F.col("is_test")), degree)
        part = experiments.score_vectors(model, table.where("is_test"), "label").withColumn("degree", F.lit(degree))
        out = part if out is None else out.unionByName(part)
    return evaluate.summary_metrics(out, "label", CLASSES, ["degree"]).select("degree", r6("accuracy"), r6("f1_weighted"))


@query
def lr_poly(spark, folder):
    return _poly_scores(spark, folder, (2,))


@query
def lr_degree_compare(spark, folder):
    return _poly_scores(spark, folder, (1, 2, 3))


@query
def w2v_vectors(spark, folder):
    docs = materialize(_lm_docs(spark, folder), "w2v-tokens")
    return vectors.trained(vectors.deal(docs)).select("word", "vector")


@query
def w2v_grid(spark, folder):
    """Document vectors of each grid point, scored by an L2 model."""
    docs = materialize(split_terms(spark, folder).withColumnRenamed("terms", "tokens"), "w2v-tokens")
    rows = None
    for size, window, model in vectors.grid_models(docs, "tokens"):
        table = sampling.encode_labels(model.transform(), "label", CLASSES)
        table = table.select("label", "is_test", "features", "target").persist()
        lr = linear.train_variants(table.where(~F.col("is_test")), variants=("l2",))["l2"]
        part = experiments.score_vectors(lr, table.where("is_test"), "label").agg(evaluate.accuracy(None, "label").alias("validation_accuracy"))
        part = part.select(F.lit(size).alias("vector_size"), F.lit(window).alias("window_size"), r6("validation_accuracy"))
        part = materialize(part, "w2v-scores")
        table.unpersist()
        model.drop()
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query
def w2v_pca(spark, folder):
    docs = materialize(_lm_docs(spark, folder), "w2v-tokens")
    model = vectors.train_word_vectors(docs)
    return vectors.project(vectors.word_vectors(model), "word", "vector")


@query
def w2v_synonyms(spark, folder):
    """The ten words nearest to each of the hundred most frequent ones."""
    docs = materialize(_lm_docs(spark, folder), "w2v-tokens")
    words = vectors.word_vectors(vectors.train_word_vectors(docs))
    asked = materialize(features.top_vocabulary(docs, 100, "tokens").select(F.col("term").alias("word")), "w2v-asked")
    return vectors.similar_words(words, asked).select("query", "word", F.col("rank").cast("long").alias("rank"), r6("similarity"))


@query
def similar_vectors(spark, folder):
    """The ten vectors nearest to every vector whose id is divisible by 50, among all."""
    table = read_table(spark, folder, "embeddings", "vec_id", "embedding")
    out = neighbours.neighbours(table, table.where("vec_id % 50 = 0"), "vec_id", "embedding")
    return out.select(F.col("query").alias("vec_id"), F.col("key").alias("other_id"), F.col("rank").cast("long").alias("rank"), r6("similarity"))


@query
def embedding_pca(spark, folder):
    return vectors.project(read_table(spark, folder, "embeddings", "vec_id", "embedding"), "vec_id", "embedding")


# ---------------------------------------------------------------- streams


@query
def stream_score(spark, folder):
    """Documents as a request stream, scored by a fitted linear pipeline."""
    train = materialize(labelled_terms(spark, folder), "stream-train")
    pipeline = scoring.linear_pipeline(train)
    root = fresh_path(spark, "stream")
    documents(spark, folder).write.parquet(f"{root}/in")
    stream = jobs.file_stream(spark, f"{root}/in", "doc_id long, text string")
    jobs.run_available(jobs.scored_stream(stream, pipeline, "doc_id"), f"{root}/out", f"{root}/checkpoint")
    out = spark.read.parquet(f"{root}/out")
    return out.select("doc_id", "prediction", r6("p_real"))


@query
def stream_clean(spark, folder):
    """Pages cleaned as they arrive."""
    root = fresh_path(spark, "stream")
    pages(spark, folder).write.parquet(f"{root}/in")
    stream = jobs.file_stream(spark, f"{root}/in", "page_id long, html string")
    jobs.run_available(jobs.cleaned_stream(stream, "html").drop("html"), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").select("page_id", "cleaned_text")


def _arrivals(spark, folder, target: str) -> DataFrame:
    """Raw CSV files of the documents in two arrivals, the second with a file of other columns; cleaned after each. ``path, status, ...`` of each file."""
    root = fresh_path(spark, "arrivals")
    rows = _broken_rows(documents(spark, folder))
    for arrival in (0, 1):
        part = rows.where(F.pmod("doc_id", F.lit(2)) == arrival)
        _write_raw(part, f"{root}/raw/arrival={arrival}")
        if arrival:
            read_table(spark, folder, "pages", "page_id", "url").write.option("header", True).csv(f"{root}/raw/arrival=2")
        jobs.clean_arrivals(spark, f"{root}/raw", ["doc_id", "tweet"], "tweet", target, f"{root}/checkpoint")
    return spark.read.parquet(f"{target}/files")


@query
def stream_ingest(spark, folder):
    """Raw files cleaned as they arrive."""
    target = fresh_path(spark, "cleaned")
    _arrivals(spark, folder, target)
    out = files.drop_blank(spark.read.parquet(f"{target}/rows"))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "cleaned_text")


@query
def stream_ingest_files(spark, folder):
    """What became of the files of each arrival."""
    out = _arrivals(spark, folder, fresh_path(spark, "cleaned"))
    arrival = F.regexp_extract("path", "/arrival=([0-9])/", 1).cast("long")
    return out.groupBy(arrival.alias("arrival"), "status").agg(F.sum("rows").alias("rows"), F.sum("skipped").alias("skipped"), F.coalesce(F.max("detail"), F.lit("")).alias("detail"))


@query
def stream_score_nb(spark, folder):
    """Documents as requests that arrive in two lots; each micro-batch is joined with the tables of a Naive Bayes."""
    model = nb_tokens(materialize(labelled_terms(spark, folder), "nb-terms")).materialized()
    root = fresh_path(spark, "stream")

    def score(batch: DataFrame) -> DataFrame:
        valid = with_terms(jobs.valid_requests(batch).where("reject_reason is null")).select("doc_id", "terms")
        terms = materialize(features.doc_terms(valid, "doc_id", outer=True), "request-terms")
        return model.score(terms, "doc_id").select("doc_id", "prediction", "confidence")

    for lot in (0, 1):
        documents(spark, folder).where(F.pmod("doc_id", F.lit(2)) == lot).write.parquet(f"{root}/in/lot={lot}")
        stream = jobs.file_stream(spark, f"{root}/in", "doc_id long, text string")
        jobs.score_batches(stream, score, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").select("doc_id", "prediction", r6("confidence"))
