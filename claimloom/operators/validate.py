"""Record constraints: every request gets a reject reason, or null when it is valid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Request limits (lengths in code points).
TEXT_LIMITS = {"preprocess": (1, 10_000), "classify": (10, 10_000), "retrieve": (1, None)}
BATCH_LIMITS = (1, 100)
TOP_K_LIMITS = (1, 20)


def text_reason(text: Column, kind: str) -> Column:
    low, high = TEXT_LIMITS[kind]
    reason = F.when(text.isNull(), "text missing").when(F.length(text) < low, "text too short")
    return reason if high is None else reason.when(F.length(text) > high, "text too long")


def batch_reason(texts: Column) -> Column:
    return F.when(texts.isNull(), "texts missing").otherwise(batch_size_reason(F.size(texts)))


def batch_size_reason(size: Column) -> Column:
    """The same rule for a batch that is a group of rows."""
    low, high = BATCH_LIMITS
    return F.when(size < low, "batch too small").when(size > high, "batch too large")


def top_k_reason(top_k: Column) -> Column:
    low, high = TOP_K_LIMITS
    return F.when((top_k < low) | (top_k > high), "top_k out of range")


def with_reason(df: DataFrame, reason: Column) -> DataFrame:
    return df.withColumn("reject_reason", reason)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) sides of a table that carries ``reject_reason``."""
    return df.where(F.col("reject_reason").isNull()).drop("reject_reason"), df.where(F.col("reject_reason").isNotNull())
