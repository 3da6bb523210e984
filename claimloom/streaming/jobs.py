"""Stateless streams: incremental cleaning of arriving files, and scoring of request streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from claimloom.functions.clean import clean
from claimloom.functions.tokens import word_tokens
from claimloom.operators.validate import text_reason
from claimloom.plans.scoring import score_linear
from claimloom.sources.files import CORRUPT, SEPARATORS, field_count, headers, plain_name


def file_stream(spark: SparkSession, folder: str, schema: StructType | str, fmt: str = "parquet", **options) -> DataFrame:
    """New files of a folder, at any depth."""
    return spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", True).options(**options).load(folder)


def run_available(stream: DataFrame, target: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Process what has arrived and stop; the checkpoint remembers finished files across runs and failures."""
    query = (
        stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(target)
    )
    query.awaitTermination()


def cleaned_stream(stream: DataFrame, text: str) -> DataFrame:
    return stream.withColumn("cleaned_text", clean(F.col(text)))


def valid_requests(stream: DataFrame, kind: str = "classify") -> DataFrame:
    return stream.withColumn("reject_reason", text_reason(F.col("text"), kind))


def scored_stream(stream: DataFrame, pipeline: PipelineModel, *keep: str) -> DataFrame:
    """Clean, split and score each row with a fitted linear pipeline: narrow, hence without state."""
    terms = stream.withColumn("terms", word_tokens(clean(F.col("text"))))
    return score_linear(pipeline, terms, *keep)


def score_batches(stream: DataFrame, score: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> None:
    """Score each micro-batch with any table job (for example Naive Bayes joins).

    The batch number is a folder name and the write overwrites it, so a replayed
    batch leaves the same result.
    """

    def write(batch: DataFrame, number: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    query = (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


ARRIVED = "path string, status string, rows long, skipped long, detail string"


def clean_arrivals(
    spark: SparkSession, folder: str, names: Sequence[str], text: str, target: str, checkpoint: str, suffix: str = ".csv",
    files_per_batch: int = 1000, multi_line: bool = True,
) -> None:
    """Clean the raw delimited files that have arrived below ``folder`` and stop; the checkpoint remembers them.

    Files have the columns ``names``. Each micro-batch holds at most ``files_per_batch`` files and is written to folders of its own
    number, so a replayed batch leaves the same result: ``rows`` (the columns, ``cleaned_text``, ``source_file``) and
    ``files`` (``ARRIVED``). Rows with too many fields are skipped and counted; a file with another header fails alone. A file
    without rows is not reported.
    """
    sep = SEPARATORS[suffix]
    stream = file_stream(
        spark, folder, StructType([StructField(c, StringType()) for c in [*names, CORRUPT]]), "csv", header=True, sep=sep, escape='"', mode="PERMISSIVE",
        multiLine=multi_line, columnNameOfCorruptRecord=CORRUPT, pathGlobFilter=f"*{suffix}", maxFilesPerTrigger=files_per_batch,
    )
    stream = stream.select(*[F.col(f"`{c}`") for c in [*names, CORRUPT]], plain_name(F.col("_metadata.file_path")).alias("source_file"))
    broken = F.col(CORRUPT).isNotNull() & (field_count(F.col(CORRUPT), sep) > len(names))
    right = F.coalesce(F.col("names") == F.array(*map(F.lit, names)), F.lit(False))

    def write(batch: DataFrame, number: int) -> None:
        paths = batch.select(F.col("source_file").alias("path")).distinct()
        found = headers(paths, sep).select(F.col("path").alias("source_file"), "error", right.alias("_right"))
        marked = batch.withColumn("_skip", F.coalesce(broken, F.lit(False))).join(F.broadcast(found), "source_file")  # files_per_batch rows at most
        cleaned = F.when(F.col("_right") & ~F.col("_skip"), clean(F.coalesce(F.col(f"`{text}`"), F.lit("nan"))))
        at = f"{target}/all/batch={number}"
        marked.withColumn("cleaned_text", cleaned).drop(CORRUPT).write.mode("overwrite").parquet(at)
        stored = spark.read.parquet(at)
        stored.where("_right and not _skip").drop("_right", "_skip", "error").write.mode("overwrite").parquet(f"{target}/rows/batch={number}")
        counts = stored.groupBy("source_file").agg(
            F.first("_right").alias("ok"), F.count_if(F.col("cleaned_text").isNotNull()).alias("rows"), F.count_if(F.col("_skip")).alias("skipped"), F.first("error").alias("error")
        )
        status = counts.select(
            F.col("source_file").alias("path"), F.when(F.col("ok"), "cleaned").otherwise("failed").alias("status"), "rows",
            F.when(F.col("ok"), F.col("skipped")).otherwise(0).alias("skipped"), F.when(~F.col("ok"), F.coalesce("error", F.lit("other columns"))).alias("detail"),
        )
        status.write.mode("overwrite").parquet(f"{target}/files/batch={number}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
