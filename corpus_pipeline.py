"""A corpus pipeline: stages that each apply one operator of ``claimloom.llm`` to what the stage before has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import bagminhash, bpe, decontaminate, lid, pii
from claimloom.llm.catalog import vocabulary
from claimloom.llm.common import Stored, read
from claimloom.session import fresh_path

#: A document whose most likely language is less likely than this is rejected.
LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with letters and one likely language; the language found replaces ``lang``."""
    return lid.identified(docs, lid.fit(docs.where(~lid.held_out(F.col("doc_id")))), LANGUAGE_SCORE)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each class of near copies; of rows with one id, one. Rows without an id stay."""
    found = bagminhash.classes(docs)
    gone = found.where("not kept and doc_id is not null").select("doc_id").distinct()
    if gone.limit(bagminhash.BROADCAST_IDS + 1).count() <= bagminhash.BROADCAST_IDS:
        gone = F.broadcast(gone)
    kept = docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")
    repeated = Stored(found.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id"), "repeated").df
    if repeated.isEmpty():
        return kept
    same = kept["doc_id"] == repeated["doc_id"]
    return kept.join(repeated, same, "left_anti").union(kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id"]))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in which no benchmark item was found."""
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document; each span of personal data becomes its kind in brackets, and ``n_chars`` is counted anew."""
    return pii.redacted(docs, pii.fit(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of the ids and of what they decode to."""
    return bpe.encoded(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: Learned models and banded signatures are not expressible in SQL; tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
