"""Serving jobs over request tables: classify, classify in batch, retrieve similar claims.

Corpus and requests go through one fitted chain: the same cleaning, the same
preprocessing and lexicon, the same vocabulary.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions.clean import clean, preview
from claimloom.functions.tokens import are_counted, repeated_terms
from claimloom.operators import features, linear, naive_bayes
from claimloom.operators.approx import similar_approx
from claimloom.operators.retrieve import similar
from claimloom.operators.sampling import encode_labels
from claimloom.operators.validate import batch_size_reason
from claimloom.plans.preprocess import SERVING, Preprocessing, analyzer_terms, fit_tokens, preprocess_tokens
from claimloom.session import materialize

CLASSES = ("fake", "real")


@dataclass
class ClaimModel:
    """Everything fitted on the labelled claims: lexicon, vocabulary and Naive Bayes."""

    options: Preprocessing
    key: str
    lexicon: DataFrame | None
    term_model: features.TermModel
    nb: naive_bayes.NaiveBayes

    def terms(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """Documents with the ``terms`` the models read; blank documents stay."""
        cleaned = docs.withColumn("cleaned_text", clean(F.col(text)))
        return analyzer_terms(
            preprocess_tokens(cleaned, self.key, self.options, lexicon_table=self.lexicon)
        )


def prepared(docs: DataFrame, key: str, options: Preprocessing, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame | None]:
    """``key, keep..., terms`` of a text table, and its lexicon. A table that has ``cleaned_text`` isn't cleaned again."""
    text = F.col("cleaned_text") if "cleaned_text" in docs.columns else clean(F.col("text"))
    cleaned = docs.select(key, *keep, text.alias("cleaned_text"))
    out, words = fit_tokens(cleaned, key, options)
    return analyzer_terms(out).select(key, *keep, "terms"), words


def fit_claims(
    labelled: DataFrame,
    key: str,
    label: str = "label",
    options: Preprocessing = SERVING,
    max_features: int = features.MAX_FEATURES,
    classes: Sequence[str] = CLASSES,
) -> ClaimModel:
    """Fit lexicon, TF-IDF vocabulary and a Naive Bayes on TF-IDF weights."""
    docs, words = prepared(labelled, key, options, (label,))
    docs = materialize(features.counted(docs), "claims")
    term_model = features.fit_terms(docs, max_features).materialized()
    weights = term_model.weights(docs, key).join(docs.select(key, label), key)
    width = term_model.vocabulary.count()
    nb = naive_bayes.fit(weights, docs, label, classes, weight="weight", n_features=width).materialized()
    return ClaimModel(options, key, words, term_model, nb)


def classify(model: ClaimModel, requests: DataFrame, k: int = 5) -> DataFrame:
    """``key, text, prediction, confidence, class_probabilities, top_contributing_features``.

    Requests without a known term score the class priors. Features are the terms of
    the request with the greatest TF-IDF weight.
    """
    key = model.key
    docs = materialize(features.counted(model.terms(requests).select(key, "text", "terms")), "requests")
    weights = materialize(model.term_model.weights(docs, key), "request-weights")
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(F.round("weight", 6)), "term"))
    # one row per document: the joint score needs the weights, the report needs the k best of them
    per_doc = weights.withColumn("rank", rank)
    scored = model.nb.joint_scores(
        weights.select(key, "term", F.col("weight").alias("tf")), key
    )
    top = (
        per_doc.where(F.col("rank") <= k)
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct("rank", "term", F.round("weight", 6).alias("weight")))).alias("top"))
    )
    classes = model.nb.classes
    scores = [F.coalesce(F.col(f"s_0_{i}"), model.nb.log_prior(i)) for i in range(len(classes))]
    joined = docs.join(scored, key, "left").join(top, key, "left")
    table = naive_bayes.with_prediction(joined, scores, classes, [key, "text", "top"])
    return table.select(
        key,
        "text",
        "prediction",
        "confidence",
        F.col("probabilities").alias("class_probabilities"),
        F.transform("top", lambda t: F.struct(t["term"].alias("term"), t["weight"].alias("weight"))).alias(
            "top_contributing_features"
        ),
    )


def classify_batch(model: ClaimModel, requests: DataFrame) -> DataFrame:
    """``key, text (preview), prediction``: the joint scores and their greatest, without the report of features."""
    key = model.key
    docs = materialize(features.counted(model.terms(requests).select(key, "text", "terms")), "requests")
    weights = materialize(model.term_model.weights(docs, key), "request-weights")
    scored = model.nb.joint_scores(weights.select(key, "term", F.col("weight").alias("tf")), key)
    classes = model.nb.classes
    scores = [F.coalesce(F.col(f"s_0_{i}"), model.nb.log_prior(i)) for i in range(len(classes))]
    return docs.join(scored, key, "left").select(key, preview(F.col("text")).alias("text"), naive_bayes.argmax(scores, classes).alias("prediction"))


def batches(requests: DataFrame, results: DataFrame, batch: str, order: str, key: str) -> DataFrame:
    """``batch, batch_size, results, reject_reason``: results (an array of text and prediction, in request order) of each valid batch.

    Batches are counted first; only those within the limits are gathered, so a gathered row is bounded.
    """
    sizes = requests.groupBy(batch).agg(F.count("*").alias("batch_size"))
    sizes = sizes.withColumn("reject_reason", batch_size_reason(F.col("batch_size")))
    valid = requests.select(batch, order, key).join(sizes.where("reject_reason is null").select(batch), batch)
    gathered = valid.join(results, key).groupBy(batch).agg(F.sort_array(F.collect_list(F.struct(order, "text", "prediction"))).alias("_r"))
    return sizes.join(gathered, batch, "left").select(
        batch, "batch_size", F.transform("_r", lambda r: F.struct(r["text"].alias("text"), r["prediction"].alias("prediction"))).alias("results"),
        "reject_reason",
    )


def classify_linear(pipeline: PipelineModel, vocabulary: DataFrame, requests: DataFrame, key: str, k: int = 5, classes: Sequence[str] = CLASSES) -> DataFrame:
    """``key, text, prediction, confidence, class_probabilities, top_contributing_features`` by logistic regression.

    ``requests`` holds ``key, text, terms``. Features are the request's terms with the
    greatest absolute coefficient; coefficients are bounded by the vocabulary.
    """
    names = sorted(classes)
    scored = pipeline.transform(requests).withColumn("_p", vector_to_array("probability"))
    table = linear.coefficients(pipeline.stages[-1], vocabulary)
    best = linear.top_features(features.doc_terms(requests.select(key, "terms"), key), table, key, k)
    top = best.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("rank", "term", F.col("coefficient").alias("weight")))).alias("_top"))
    out = scored.select(key, "text", "prediction", "_p").join(top, key, "left")
    return out.select(
        key, "text", F.get(F.array(*map(F.lit, names)), F.col("prediction").cast("int")).alias("prediction"), F.array_max("_p").alias("confidence"),
        F.map_from_arrays(F.array(*map(F.lit, names)), "_p").alias("class_probabilities"),
        F.transform("_top", lambda t: F.struct(t["term"].alias("term"), t["weight"].alias("weight"))).alias("top_contributing_features"),
    )


def retrieve(
    corpus: DataFrame, queries: DataFrame, key: str, query_key: str, top_k: int | str = 5, options: Preprocessing = SERVING,
    max_features: int = features.MAX_FEATURES, prune: bool = True, approx: float | None = None,
) -> DataFrame:
    """``query_key, key, similarity, rank``: the claims of the corpus most similar to each query.

    ``top_k`` is a number, or the column of ``queries`` that holds each request's own. ``approx`` asks for claims of at
    least this similarity only, found by hash bands (see ``approx.similar_approx``); without it the search is exact.
    """
    docs, words = prepared(corpus, key, options)
    docs = materialize(features.counted(docs), "corpus-terms")
    term_model = features.fit_terms(docs, max_features).materialized()
    cleaned = queries.select(query_key, clean(F.col("text")).alias("cleaned_text"))
    asked = analyzer_terms(preprocess_tokens(cleaned, query_key, options, lexicon_table=words))
    asked = materialize(term_model.weights(asked, query_key), "queries")
    weights = materialize(term_model.weights(docs, key).select(key, "term_id", "weight"), "corpus-weights")
    if approx is not None:
        return similar_approx(asked, weights, queries, docs, query_key, key, top_k, approx)
    return similar(asked, weights, queries, docs, query_key, key, top_k, prune)


def vector_table(docs: DataFrame, term_model: features.TermModel, label: str | None = None, classes=CLASSES):
    """``features`` (and ``target``) for the linear models, and the fitted vectorizer. ``terms`` may be counted; they leave as plain ones."""
    vectorizer = term_model.vectorizer()
    if are_counted(docs, "terms"):
        docs = docs.withColumn("terms", repeated_terms(F.col("terms")))
    out = vectorizer.transform(docs).drop("_counts", "_weighted")
    return (encode_labels(out, label, classes) if label else out), vectorizer


def linear_pipeline(
    labelled: DataFrame, label: str = "label", variant: str = "l2", max_features: int = features.MAX_FEATURES,
    terms: str = "terms", term_model: features.TermModel | None = None,
) -> PipelineModel:
    """Vocabulary, idf weights and model in one persistable pipeline over a ``terms`` column.

    All stages are narrow, so the same object scores tables and streams.
    """
    if term_model is None:
        term_model = features.fit_terms(labelled, max_features, terms=terms).materialized()
    train, vectorizer = vector_table(labelled, term_model, label)
    train = train.select("features", "target").persist()
    model = linear.train_variants(train, variants=(variant,))[variant]
    train.unpersist()
    return PipelineModel([*vectorizer.stages, model])


def score_linear(pipeline: PipelineModel, docs: DataFrame, *keep: str, classes: Sequence[str] = CLASSES) -> DataFrame:
    """``keep..., prediction, p_<last class>`` without any shuffle."""
    out = pipeline.transform(docs)
    names = F.array(*[F.lit(c) for c in sorted(classes)])
    return out.select(
        *keep,
        F.get(names, F.col("prediction").cast("int")).alias("prediction"),
        F.get(vector_to_array("probability"), F.lit(1)).alias(f"p_{sorted(classes)[1]}"),
    )
