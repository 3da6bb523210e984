"""Classifier evaluation from (label, prediction) and (label, score) tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.operators.sampling import hash_sample
from claimloom.session import broadcast_bounded, materialize


def accuracy(df: DataFrame, label: str, prediction: str = "prediction") -> Column:
    return F.avg((F.col(label) == F.col(prediction)).cast("double"))


def confusion(df: DataFrame, label: str, classes: Sequence[str], prediction: str = "prediction") -> DataFrame:
    """``label, prediction, n`` for every pair of classes, empty cells included.

    One global aggregate with a conditional count per cell; the grid is unfolded from
    its single row, so no class table is crossed.
    """
    cells = [(a, p, f"n_{i}_{j}") for i, a in enumerate(classes) for j, p in enumerate(classes)]
    row = df.agg(*[F.count_if((F.col(label) == a) & (F.col(prediction) == p)).alias(n) for a, p, n in cells])
    return row.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(a).alias("label"), F.lit(p).alias("prediction"), F.col(n).alias("n")) for a, p, n in cells]
            )
        )
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def class_report(
    df: DataFrame, label: str, classes: Sequence[str], prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """``by..., class, precision, recall, f1, support`` with accuracy, macro and weighted rows.

    ``by`` evaluates many models in the same pass. A ratio with a zero denominator is 0.
    """
    y, p = F.col(label), F.col(prediction)
    aggs = [F.count("*").alias("n"), F.count_if(y == p).alias("hits")]
    for i, c in enumerate(classes):
        aggs += [
            F.count_if((y == c) & (p == c)).alias(f"tp{i}"),
            F.count_if(p == c).alias(f"pp{i}"),
            F.count_if(y == c).alias(f"sup{i}"),
        ]
    counts = df.groupBy(*by).agg(*aggs)

    def row(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.alias("support"),
        )

    parts = []
    for i, c in enumerate(classes):
        tp, pp, sup = F.col(f"tp{i}"), F.col(f"pp{i}"), F.col(f"sup{i}")
        parts.append((c, _ratio(tp, pp), _ratio(tp, sup), _ratio(2 * tp, pp + sup), sup))
    k = len(parts)
    n = F.col("n")

    def mean(column, weighted):
        terms = [x[column] * x[4] / n if weighted else x[column] / k for x in parts]
        return sum(terms[1:], terms[0])

    acc = _ratio(F.col("hits"), n)
    rows = [row(*x) for x in parts]
    rows.append(row("accuracy", acc, acc, acc, n))
    rows.append(row("macro avg", mean(1, False), mean(2, False), mean(3, False), n))
    rows.append(row("weighted avg", mean(1, True), mean(2, True), mean(3, True), n))
    return counts.where("n > 0").select(*by, F.inline(F.array(*rows)))


def summary_metrics(df: DataFrame, label: str, classes: Sequence[str], by: Sequence[str], prediction: str = "prediction"):
    """One row per model: ``by..., accuracy, f1_weighted`` and precision, recall, f1 per class."""
    report = class_report(df, label, classes, prediction, by)
    pick = lambda name, col: F.max(F.when(F.col("class") == name, F.col(col)))
    metrics = [pick("accuracy", "f1").alias("accuracy"), pick("weighted avg", "f1").alias("f1_weighted")]
    for c in classes:
        metrics += [pick(c, m).alias(f"{m}_{c}") for m in ("precision", "recall", "f1")]
    return report.groupBy(*by).agg(*metrics)


#: Points of a curve that one task sums.
POINTS = 1_000_000


def roc_curve(df: DataFrame, positive: Column, score: str, points: int = POINTS) -> DataFrame:
    """``score, pos, neg, fpr, tpr`` at every distinct score, greatest first.

    Rows collapse to distinct scores, which are dealt by range over partitions of about ``points`` scores and stored with
    the number of their partition. Sums of the partitions before it (a row per partition) are added to the running sums
    inside each. No window runs over all scores in one task, whatever their number.
    """
    distinct = materialize(
        df.groupBy(F.col(score).alias("score")).agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")), "roc-scores"
    )
    parts = max(1, -(-distinct.count() // points))
    dealt = distinct.repartitionByRange(parts, F.desc("score")).withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "roc-ranges")
    sizes = dealt.groupBy("part").agg(F.sum("pos").alias("bp"), F.sum("neg").alias("bn"))
    above = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "part",
        F.coalesce(F.sum("bp").over(above), F.lit(0)).alias("op"),
        F.coalesce(F.sum("bn").over(above), F.lit(0)).alias("on"),
    )
    totals = sizes.agg(F.struct(F.sum("bp").alias("p"), F.sum("bn").alias("n"))).scalar()
    inside = Window.partitionBy("part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    return dealt.join(broadcast_bounded(offsets, parts), "part").select(
        "score",
        "pos",
        "neg",
        _ratio(F.col("on") + F.sum("neg").over(inside), totals["n"]).alias("fpr"),
        _ratio(F.col("op") + F.sum("pos").over(inside), totals["p"]).alias("tpr"),
    )


def roc_auc(df: DataFrame, positive: Column, score: str, points: int = POINTS) -> DataFrame:
    """Trapezoid area: each point adds its negatives times the mean true-positive rate across it."""
    curve = roc_curve(df, positive, score, points)
    positives = F.sum("pos")
    negatives = F.sum("neg")
    area = F.sum(F.col("neg") * F.col("tpr")) - F.sum(F.col("neg") * F.col("pos")) / (2 * positives)
    return curve.agg(F.when(positives * negatives > 0, area / negatives).alias("roc_auc"))


def misclassified(
    df: DataFrame, key: str, label: str, text: str, oov_share: str, n: int = 30, oov_limit: float = 0.5
) -> DataFrame:
    """A seeded sample of the errors, tagged by what may explain them."""
    wrong = df.where(F.col(label) != F.col("prediction"))
    bucket = (
        F.when(F.col(oov_share) > oov_limit, "oov")
        .when(F.col(text).rlike("[\"“”«»„]"), "quotes")
        .otherwise("other")
    )
    return hash_sample(wrong.withColumn("bucket", bucket), key, n)
