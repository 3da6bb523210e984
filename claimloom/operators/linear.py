"""Regularised logistic regression on sparse term vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import PolynomialExpansion, UnivariateFeatureSelector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Share of the L1 penalty per variant.
VARIANTS = {"l1": 1.0, "l2": 0.0, "elasticnet": 0.5}


def logistic(variant: str, n_rows: int, C: float = 1.0, max_iter: int = 100, weight: str | None = None):
    """An estimator whose penalty equals ``C * sum(loss) + R(w)`` after division by ``C * n``."""
    lr = LogisticRegression(
        featuresCol="features",
        labelCol="target",
        regParam=1.0 / (C * n_rows),
        elasticNetParam=VARIANTS[variant],
        standardization=False,
        maxIter=max_iter,
        tol=1e-4,
    )
    return lr.setWeightCol(weight) if weight else lr


def compact(train: DataFrame, n_rows: int, rows_per_task: int = 20_000) -> DataFrame:
    """Fewer partitions for a small training table: every optimizer step is one job over all of them."""
    return train.coalesce(max(1, n_rows // rows_per_task))


def train_variants(
    train: DataFrame, C: float = 1.0, variants: Sequence[str] = tuple(VARIANTS), weight: str | None = None
) -> dict[str, LogisticRegressionModel]:
    """One model per penalty from a ``features, target`` table (cached by the caller: fits iterate over it)."""
    n = train.count()
    train = compact(train, n)
    return {v: logistic(v, n, C, 1000 if v == "elasticnet" else 100, weight).fit(train) for v in variants}


def coefficients(model: LogisticRegressionModel, vocabulary: DataFrame) -> DataFrame:
    """``word, coefficient, abs_val`` of every column of the model.

    The weights are already on the driver (one per vocabulary term) and meet the
    vocabulary table by column id.
    """
    spark = vocabulary.sparkSession
    rows = [(i, float(c)) for i, c in enumerate(model.coefficients.toArray())]
    table = spark.createDataFrame(rows, "term_id int, coefficient double")
    return vocabulary.join(F.broadcast(table), "term_id").select(
        F.col("term").alias("word"), "coefficient", F.abs("coefficient").alias("abs_val")
    )


def feature_importance(model: LogisticRegressionModel, vocabulary: DataFrame) -> DataFrame:
    return coefficients(model, vocabulary).orderBy(F.desc("abs_val"), "word")


def all_importances(models: dict[str, LogisticRegressionModel], vocabulary: DataFrame) -> DataFrame:
    out = None
    for variant, model in models.items():
        part = coefficients(model, vocabulary).withColumn("variant", F.lit(variant))
        out = part if out is None else out.unionByName(part)
    return out.select("variant", "word", "coefficient", "abs_val")


def weight_summary(importances: DataFrame) -> DataFrame:
    """Per variant: how many weights are not zero, and the greatest."""
    return importances.groupBy("variant").agg(
        F.count_if(F.col("abs_val") > 0).alias("nonzero_weights"), F.max("abs_val").alias("max_weight")
    )


def top_features(doc_terms: DataFrame, importances: DataFrame, key: str, k: int = 5) -> DataFrame:
    """The k terms of each document with the greatest absolute coefficient (at most one row per vocabulary term)."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("abs_val"), "term"))
    return (
        doc_terms.join(F.broadcast(importances.withColumnRenamed("word", "term")), "term")
        .withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select(key, "rank", "term", "coefficient")
    )


def train_polynomial(train: DataFrame, degree: int = 2, selected: int = 20, C: float = 1.0) -> PipelineModel:
    """Polynomial terms of the ``selected`` best columns, then an L2 model.

    Expanding thousands of columns gives millions of features per row, so the columns
    are first cut by an F-test (analysis of variance); the intercept stands for the bias column.
    """
    selector = UnivariateFeatureSelector(
        featuresCol="features", labelCol="target", outputCol="_selected", selectionMode="numTopFeatures"
    )
    selector = selector.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(selected)
    expand = PolynomialExpansion(degree=degree, inputCol="_selected", outputCol="_expanded")
    n = train.count()
    lr = logistic("l2", n, C, 1000).setFeaturesCol("_expanded")
    return Pipeline(stages=[selector, expand, lr]).fit(compact(train, n))
