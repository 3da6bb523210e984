"""Audits of the text preparation: noise removed, tokenizers compared, out-of-vocabulary rate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.clean import clean, preview
from claimloom.functions.tokens import regex_tokens, treebank_tokens, whitespace_tokens
from claimloom.operators.keyed import lookup
from claimloom.operators.sampling import hash_sample


def noise_audit(df: DataFrame, key: str, text: str = "text", n: int = 200, seed: int = 42) -> DataFrame:
    """``key, text, cleaned_text, original_len, cleaned_len`` of a seeded sample."""
    sample = hash_sample(df.select(key, text), key, n, seed)
    return sample.withColumn("cleaned_text", clean(F.col(text))).select(
        key, text, "cleaned_text", F.length(text).alias("original_len"), F.length("cleaned_text").alias("cleaned_len")
    )


def noise_summary(audit: DataFrame) -> DataFrame:
    """Mean share of characters removed."""
    return audit.where("original_len > 0").agg(
        F.avg(1 - F.col("cleaned_len") / F.col("original_len")).alias("noise_reduction")
    )


def tokenizer_counts(df: DataFrame, key: str, text: str, n: int | None = 50, seed: int = 42) -> DataFrame:
    """Token counts per document and method; ``n`` samples documents, None takes all."""
    rows = df if n is None else hash_sample(df, key, n, seed)
    value = F.col(text)
    return rows.select(
        key,
        preview(value).alias("preview"),
        F.size(treebank_tokens(value)).alias("treebank_count"),
        F.size(regex_tokens(value)).alias("regex_count"),
        F.size(whitespace_tokens(value)).alias("whitespace_count"),
    )


def tokenizer_summary(counts: DataFrame) -> DataFrame:
    return counts.agg(*[F.avg(f"{m}_count").alias(f"avg_{m}") for m in ("treebank", "regex", "whitespace")])


def oov_rate(docs: DataFrame, vocab: DataFrame, key: str, tokens: str = "tokens") -> DataFrame:
    """``key, tokens, oov, oov_rate``: token occurrences, not distinct words, missing from the vocabulary.

    Occurrences of a term collapse inside each document before the lookup, and a term that many
    documents hold is split over tasks. A document without tokens has rate 0. ``vocab`` should be a stored table.
    """
    from claimloom.operators.features import doc_terms

    lower = docs.select(key, F.transform(tokens, lambda t: F.lower(t)).alias("terms"))
    known = vocab.select("term", F.lit(True).alias("known"))
    joined = lookup(doc_terms(lower, key, outer=True), known, "term", [key], "left")
    tf = F.coalesce("tf", F.lit(0))
    return joined.groupBy(key).agg(
        F.sum(tf).alias("tokens"), F.sum(F.when(F.col("known").isNull(), tf).otherwise(0)).alias("oov")
    ).select(key, "tokens", "oov", F.when(F.col("tokens") == 0, 0.0).otherwise(F.col("oov") / F.col("tokens")).alias("oov_rate"))
