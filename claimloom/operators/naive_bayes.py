"""Multinomial Naive Bayes as aggregates and joins.

A model is a table with one row per term (counts per class) and a few scalars per
class. The scalars are subqueries over the very aggregate that feeds the term table,
so training stays lazy and reads the corpus once for both.

Inputs in long form are ``key, term, weight`` rows: token counts, or TF-IDF weights
taken as fractional counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.operators.keyed import lookup
from claimloom.session import BROADCAST_ROWS, materialize

# Smoothing constants of the sensitivity sweep.
ALPHAS = (0.01, 0.1, 0.5, 1.0, 2.0, 5.0)


@dataclass
class NaiveBayes:
    """A trained model. ``alpha`` is applied when likelihoods are read, so one training serves every alpha."""

    classes: Sequence[str]
    counts: DataFrame  # term, c0, c1, ...
    totals: Column  # scalar struct: n_terms, t0, t1, ...
    priors: Column  # scalar struct: n, n0, n1, ...
    n_features: int | None = None

    def materialized(self) -> NaiveBayes:
        """The same model with its counts written once; the scalars are taken from the written table."""
        counts = materialize(self.counts, "nb-counts")
        return replace(self, counts=counts, totals=_totals(counts, len(self.classes)))

    def log_prior(self, i: int) -> Column:
        return F.log(self.priors[f"n{i}"] / self.priors["n"])

    def _denominator(self, i: int, alpha: float) -> Column:
        width = self.totals["n_terms"] if self.n_features is None else F.lit(self.n_features)
        return self.totals[f"t{i}"] + F.lit(alpha) * width

    def default(self, i: int, alpha: float) -> Column:
        """Log likelihood of a term the class has never seen."""
        return F.log(F.lit(alpha) / self._denominator(i, alpha))

    def likelihood(self, i: int, alpha: float) -> Column:
        """Log likelihood of a term after a left join with ``counts``."""
        return F.log((F.coalesce(F.col(f"c{i}"), F.lit(0)) + F.lit(alpha)) / self._denominator(i, alpha))

    def class_table(self, alpha: float = 1.0) -> DataFrame:
        """``class, log_prior, default_ll``."""
        one = self.counts.sparkSession.range(1)
        rows = [
            F.struct(
                F.lit(c).alias("class"),
                self.log_prior(i).alias("log_prior"),
                self.default(i, alpha).alias("default_ll"),
            )
            for i, c in enumerate(self.classes)
        ]
        return one.select(F.inline(F.array(*rows)))

    def term_table(self, alpha: float = 1.0) -> DataFrame:
        """``term, class, cnt, ll`` for the terms a class has seen."""
        rows = [
            F.struct(
                F.lit(c).alias("class"), F.col(f"c{i}").alias("cnt"), self.likelihood(i, alpha).alias("ll")
            )
            for i, c in enumerate(self.classes)
        ]
        return self.counts.select("term", F.inline(F.array(*rows))).where("cnt > 0")

    def joint_scores(self, terms: DataFrame, *keys: str, alphas: Sequence[float] = (1.0,)) -> DataFrame:
        """``keys..., s_<alpha index>_<class index>``: the joint log score of every class.

        ``terms`` holds one row per document and term (``term`` null for an empty
        document). One left join on the term and one aggregate per document; all
        classes and all alphas are summed in the same pass. A model of few terms is
        broadcast. Of a larger one the most frequent terms are, which most rows hold: these
        are summed where they are read, and only rows of rarer terms are shuffled.
        The model should be a stored one; ``terms`` is then read more than once.
        """
        joined = self._with_counts(terms, keys)
        weight = F.when(F.col("term").isNull(), 0.0).otherwise(F.col("tf").cast("double"))
        sums = [
            F.sum(weight * self.likelihood(i, a)).alias(f"s_{j}_{i}")
            for j, a in enumerate(alphas)
            for i in range(len(self.classes))
        ]
        out = joined.groupBy(*keys).agg(*sums)
        for j in range(len(alphas)):
            for i in range(len(self.classes)):
                out = out.withColumn(f"s_{j}_{i}", F.col(f"s_{j}_{i}") + self.log_prior(i))
        return out

    def _with_counts(self, terms: DataFrame, keys: Sequence[str], most: int = BROADCAST_ROWS) -> DataFrame:
        """``terms`` with the columns of ``counts``, null where the model has none."""
        if self.counts.limit(most + 1).count() <= most:
            return lookup(terms, self.counts, "term", list(keys), "left")
        names = [f"c{i}" for i in range(len(self.classes))]
        seen = sum((F.col(c) for c in names[1:]), F.col(names[0]))
        top = materialize(self.counts.orderBy(F.desc(seen), "term").limit(most).withColumn("_top", F.lit(True)), "nb-frequent")
        marked = terms.join(F.broadcast(top), "term", "left")
        known = F.col("_top").isNotNull() | F.col("term").isNull()
        rare = lookup(marked.where(~known).drop("_top", *names), self.counts, "term", list(keys), "left")
        return marked.where(known).drop("_top").unionByName(rare)

    def score(self, terms: DataFrame, *keys: str, alpha: float = 1.0) -> DataFrame:
        """``keys..., scores, probabilities, prediction, confidence``; score ties go to the smallest class."""
        joint = self.joint_scores(terms, *keys, alphas=(alpha,))
        return with_prediction(joint, [F.col(f"s_0_{i}") for i in range(len(self.classes))], self.classes, keys)


def argmax(scores: Sequence[Column], classes: Sequence[str]) -> Column:
    """Class of the greatest score; the first class in order wins a tie."""
    best = F.greatest(*scores)
    chosen = F.when(scores[0] == best, F.lit(classes[0]))
    for score, name in zip(scores[1:], classes[1:]):
        chosen = chosen.when(score == best, F.lit(name))
    return chosen


def softmax(scores: Sequence[Column]) -> list[Column]:
    """Class probabilities with the usual shift by the greatest score."""
    best = F.greatest(*scores)
    exps = [F.exp(s - best) for s in scores]
    total = sum(exps[1:], exps[0])
    return [e / total for e in exps]


def with_prediction(df: DataFrame, scores: Sequence[Column], classes: Sequence[str], keys: Sequence[str]) -> DataFrame:
    names = [F.lit(c) for c in classes]
    probabilities = softmax(scores)
    out = df.select(
        *keys,
        F.map_from_arrays(F.array(*names), F.array(*scores)).alias("scores"),
        F.array(*probabilities).alias("_p"),
        argmax(scores, classes).alias("prediction"),
    )
    return out.select(
        *keys,
        "scores",
        F.map_from_arrays(F.array(*names), F.col("_p")).alias("probabilities"),
        "prediction",
        F.array_max("_p").alias("confidence"),
    )


def _priors(docs: DataFrame, label: str, classes: Sequence[str]) -> Column:
    counts = [F.count_if(F.col(label) == c).alias(f"n{i}") for i, c in enumerate(classes)]
    return docs.agg(F.struct(F.count(label).alias("n"), *counts)).scalar()


def _totals(counts: DataFrame, k: int) -> Column:
    sums = [F.sum(f"c{i}").alias(f"t{i}") for i in range(k)]
    return counts.agg(F.struct(F.count("*").alias("n_terms"), *sums)).scalar()


def fit(
    terms: DataFrame,
    docs: DataFrame,
    label: str,
    classes: Sequence[str],
    weight: str = "tf",
    n_features: int | None = None,
) -> NaiveBayes:
    """Train from long rows ``label, term, <weight>``; ``docs`` gives the class priors.

    Term counts of all classes come from one partially aggregated shuffle on the
    term, so a class or a term with most of the rows is no hot spot. ``n_features``
    is the column count of a term matrix; without it the vocabulary is what was seen.
    """
    classes = sorted(classes)
    w = F.col(weight)
    zero = F.lit(0).cast(terms.schema[weight].dataType)
    per_class = [F.sum(F.when(F.col(label) == c, w).otherwise(zero)).alias(f"c{i}") for i, c in enumerate(classes)]
    seen = terms.where(F.col("term").isNotNull() & F.col(label).isNotNull())
    counts = seen.groupBy("term").agg(*per_class)
    return NaiveBayes(classes, counts, _totals(counts, len(classes)), _priors(docs, label, classes), n_features)


def alpha_sweep(
    model: NaiveBayes, test_terms: DataFrame, key: str, label: str, alphas: Sequence[float] = ALPHAS
) -> DataFrame:
    """``alpha, <key>, <label>, prediction`` for every alpha, from one scoring pass."""
    joint = model.joint_scores(test_terms, key, label, alphas=alphas)
    k = len(model.classes)
    rows = [
        F.struct(
            F.lit(float(a)).alias("alpha"),
            argmax([F.col(f"s_{j}_{i}") for i in range(k)], model.classes).alias("prediction"),
        )
        for j, a in enumerate(alphas)
    ]
    return joint.select(key, label, F.inline(F.array(*rows)))
