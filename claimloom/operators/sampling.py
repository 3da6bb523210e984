"""Sampling, splitting, label encoding and dataset profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_key(key: Column | str, seed: int = 42) -> Column:
    """A uniform hexadecimal hash of a key: the stateless source of randomness everywhere here."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string") if isinstance(key, str) else key.cast("string")))


def head(df: DataFrame, key: str, n: int) -> DataFrame:
    """First rows by key."""
    return df.orderBy(key).limit(n)


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A seeded sample of exactly ``min(n, rows)`` rows: a top-k on the hash, not a global sort."""
    return df.orderBy(hash_key(key, seed), key).limit(n)


def with_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test``; a row's side never changes as the data grows."""
    threshold = f"{int(test_size * 0xFFFFFFFF):08x}"
    return df.withColumn("is_test", hash_key(key, seed) < threshold)


def encode_labels(df: DataFrame, label: str, classes: Sequence[str], output: str = "target") -> DataFrame:
    """Label to its position in the sorted class list; unknown labels give null."""
    mapping = F.create_map(*[F.lit(x) for i, c in enumerate(sorted(classes)) for x in (c, i)])
    return df.withColumn(output, F.try_element_at(mapping, F.col(label)))


def decode_labels(target: Column, classes: Sequence[str]) -> Column:
    """Position back to label; an unknown position prints as itself."""
    mapping = F.create_map(*[F.lit(x) for i, c in enumerate(sorted(classes)) for x in (i, c)])
    return F.coalesce(F.try_element_at(mapping, target.cast("int")), target.cast("string"))


def classes_of(df: DataFrame, label: str) -> list[str]:
    """Sorted class list: one row per class comes back."""
    return sorted(r[0] for r in df.select(label).where(F.col(label).isNotNull()).distinct().collect())


def class_priors(df: DataFrame, label: str) -> DataFrame:
    """``label, n, prior, weight`` with the balanced weight ``N / (k * n)``.

    The totals are a scalar subquery over the same per-class counts.
    """
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("rows"), F.count("*").alias("k"))).scalar()
    return counts.select(
        label,
        "n",
        (F.col("n") / totals["rows"]).alias("prior"),
        F.log(F.col("n") / totals["rows"]).alias("log_prior"),
        (totals["rows"] / (totals["k"] * F.col("n"))).alias("weight"),
    )


def dataset_profile(df: DataFrame, text: str, label: str) -> DataFrame:
    """Per label: documents, share, distinct texts and duplicate rate.

    Texts collapse to their hash counts first, so a label holding most rows, or one
    text copied everywhere, is partially aggregated before the shuffle.
    """
    by_text = df.groupBy(label, F.md5(text).alias("h")).agg(F.count("*").alias("c"))
    per_label = by_text.groupBy(label).agg(F.sum("c").alias("documents"), F.count("*").alias("distinct_texts"))
    total = per_label.agg(F.sum("documents")).scalar()
    return per_label.select(
        label,
        "documents",
        "distinct_texts",
        (F.col("documents") / total).alias("share"),
        (1 - F.col("distinct_texts") / F.col("documents")).alias("duplicate_rate"),
    )


def first_copies(df: DataFrame, key: str, text: str) -> DataFrame:
    """Key of the first copy of every distinct text, with the number of copies.

    Only hashes and keys are shuffled, and copies collapse map-side.
    """
    return df.groupBy(F.md5(text).alias("text_hash")).agg(F.min(key).alias(key), F.count("*").alias("copies"))


def drop_duplicates(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.join(first_copies(df, key, text).select(key), key, "left_semi")
