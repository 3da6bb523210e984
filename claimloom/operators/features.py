"""Bag of words and TF-IDF in long form, and as sparse vectors for the linear models.

Long form rows are ``key, term_id, term, tf, weight``. Term counts are taken inside
each document row; a vocabulary is a top-k, so it is bounded and broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions.tokens import are_counted, term_counts
from claimloom.session import broadcast_bounded, materialize

MAX_FEATURES = 5000


def doc_terms(docs: DataFrame, *keep: str, terms: str = "terms", outer: bool = False) -> DataFrame:
    """``keep..., term, tf``: one row per distinct term of a document.

    With ``outer`` a document without terms stays as one row with a null term.
    ``terms`` holds tokens, or counts (see ``counted``).
    """
    explode = F.inline_outer if outer else F.inline
    return docs.select(*keep, explode(F.col(terms) if are_counted(docs, terms) else term_counts(F.col(terms))))


def counted(docs: DataFrame, terms: str = "terms") -> DataFrame:
    """``docs`` with the tokens of ``terms`` counted: for a table that is stored and whose terms are read more than once."""
    return docs.withColumn(terms, term_counts(F.col(terms)))


def term_stats(docs: DataFrame, terms: str = "terms") -> DataFrame:
    """``term, tf, df`` over a corpus."""
    return doc_terms(docs, terms=terms).groupBy("term").agg(F.sum("tf").alias("tf"), F.count("*").alias("df"))


def top_vocabulary(docs: DataFrame, max_features: int = MAX_FEATURES, terms: str = "terms") -> DataFrame:
    """``term_id, term, tf, df`` of the most frequent terms; ids are alphabetical.

    The cut is a distributed top-k; the numbering window runs over the kept rows only.
    """
    top = term_stats(docs, terms).orderBy(F.desc("tf"), "term").limit(max_features)
    return top.withColumn("term_id", F.row_number().over(Window.orderBy("term")) - 1)


def idf_weight(n_docs: Column, df: Column, smooth: bool = True) -> Column:
    if smooth:
        return F.log((n_docs + 1) / (df + 1)) + 1
    return F.log(n_docs / df) + 1


@dataclass
class TermModel:
    """A fitted vocabulary with document frequencies and idf weights."""

    vocabulary: DataFrame  # term_id, term, tf, df, idf
    max_features: int
    sublinear: bool = False

    def materialized(self) -> TermModel:
        """The same model with its vocabulary written once: for models that are applied more than once."""
        return replace(self, vocabulary=materialize(self.vocabulary, "vocabulary"))

    def counts(self, docs: DataFrame, key: str, terms: str = "terms") -> DataFrame:
        """Bag of words: ``key, term_id, term, tf``."""
        vocab = broadcast_bounded(self.vocabulary.select("term", "term_id"), self.max_features)
        return doc_terms(docs, key, terms=terms).join(vocab, "term").select(key, "term_id", "term", "tf")

    def weights(self, docs: DataFrame, key: str, terms: str = "terms") -> DataFrame:
        """L2-normalised TF-IDF: ``key, term_id, term, tf, weight``.

        One shuffle at most: a document's terms are gathered with their squared norm
        (the group is bounded by the vocabulary) and unfolded again in place, which
        leaves the result partitioned by document.
        """
        vocab = broadcast_bounded(self.vocabulary.select("term", "term_id", "idf"), self.max_features)
        tf = F.col("tf").cast("double")
        raw = (F.log(tf) + 1 if self.sublinear else tf) * F.col("idf")
        weighted = doc_terms(docs, key, terms=terms).join(vocab, "term").withColumn("raw", raw)
        gathered = weighted.groupBy(key).agg(
            F.sort_array(F.collect_list(F.struct("term_id", "term", "tf", "raw"))).alias("row"),
        )
        norm = F.sqrt(F.aggregate("row", F.lit(0.0), lambda acc, x: acc + x["raw"] * x["raw"]))
        unfolded = gathered.withColumn("norm", norm).select(key, "norm", F.inline("row"))
        return unfolded.select(key, "term_id", "term", "tf", (F.col("raw") / F.col("norm")).alias("weight"))

    def vectorizer(self, terms: str = "terms", output: str = "features") -> PipelineModel:
        """The same weights as a persistable ML pipeline of narrow stages (terms -> sparse vector).

        The vocabulary comes to the driver: at most ``max_features`` rows.
        """
        rows = self.vocabulary.orderBy("term").select("term", "idf").collect()
        counter = CountVectorizerModel.from_vocabulary([r["term"] for r in rows], terms, "_counts")
        idf = ElementwiseProduct(
            inputCol="_counts", outputCol="_weighted", scalingVec=Vectors.dense([r["idf"] for r in rows])
        )
        return PipelineModel([counter, idf, Normalizer(inputCol="_weighted", outputCol=output, p=2.0)])


def fit_terms(
    docs: DataFrame,
    max_features: int = MAX_FEATURES,
    variant: str = "smooth",
    terms: str = "terms",
) -> TermModel:
    """Fit a vocabulary; ``variant`` is ``smooth``, ``sublinear`` (smooth idf, log tf) or ``standard``.

    The number of documents counts empty ones too and is a scalar subquery.
    """
    if variant not in ("smooth", "sublinear", "standard"):
        raise ValueError(f"unknown TF-IDF variant: {variant}")
    n_docs = docs.agg(F.count("*")).scalar()
    vocab = top_vocabulary(docs, max_features, terms).withColumn(
        "idf", idf_weight(n_docs, F.col("df"), variant != "standard")
    )
    return TermModel(vocab, max_features, variant == "sublinear")


def sparsity(counts: DataFrame, docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """Matrix shape, stored cells and sparsity percentage; empty documents count as rows."""
    n_rows = docs.agg(F.count("*")).scalar()
    n_cols = vocab.agg(F.count("*")).scalar()
    filled = counts.agg(F.count("*").alias("nnz"))
    return filled.select(
        n_rows.alias("matrix_rows"), n_cols.alias("matrix_cols"), F.col("nnz").alias("non_zero_elements")
    ).select("*", (100 * (1 - F.col("non_zero_elements") / (F.col("matrix_rows") * F.col("matrix_cols"))))
             .alias("sparsity_percentage"))


def weight_stats(weights: DataFrame, docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """Largest weight, and the mean over all cells including zeros."""
    n_rows = docs.agg(F.count("*")).scalar()
    n_cols = vocab.agg(F.count("*")).scalar()
    return weights.agg(F.max("weight").alias("max_tfidf_value"), F.sum("weight").alias("total")).select(
        "max_tfidf_value", (F.col("total") / (n_rows * n_cols)).alias("mean_tfidf_value")
    )


def discriminative_terms(weights: DataFrame, docs: DataFrame, key: str, label: str, k: int = 5) -> DataFrame:
    """Terms with the greatest mean weight per class (zeros included in the mean)."""
    sizes = docs.groupBy(label).agg(F.count("*").alias("n"))
    sums = weights.join(docs.select(key, label), key).groupBy(label, "term").agg(F.sum("weight").alias("total"))
    means = sums.join(sizes, label).select(
        label, "term", F.round(F.col("total") / F.col("n"), 6).alias("mean_weight")
    )
    rank = F.row_number().over(Window.partitionBy(label).orderBy(F.desc("mean_weight"), "term"))
    return means.withColumn("rank", rank).where(F.col("rank") <= k)
