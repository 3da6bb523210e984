"""Reading the claim tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# At the default split size, 16 splits are 2 GB.
SPLITS = 16


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash a scan of a few splits by key, so that a one-file table isn't worked on by one core.

    Only a scan of fewer than SPLITS splits is moved, so a table of any size never has its
    texts shuffled by this, however many cores there are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= min(cores, SPLITS):
        return df
    return df.repartition(cores, *keys)


def read_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, text`` of the whole corpus."""
    return spread(read_table(spark, folder, "documents", "doc_id", "text"), "doc_id")


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, text, label`` of the documents that carry a label (``real`` or ``fake``)."""
    labels = read_table(spark, folder, "labels", "doc_id", "quality").select(
        "doc_id", F.when(F.col("quality") == 1, "real").otherwise("fake").alias("label")
    )
    return documents(spark, folder).join(labels, "doc_id")


def documents_with_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Every document; ``label`` is null where none is known."""
    labels = read_table(spark, folder, "labels", "doc_id", "quality").select(
        "doc_id", F.when(F.col("quality") == 1, "real").otherwise("fake").alias("label")
    )
    return documents(spark, folder).join(labels, "doc_id", "left")
