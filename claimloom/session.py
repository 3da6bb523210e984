"""Session helpers: shared scratch folder, materialised tables, size-checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A table with at most this many (narrow) rows is small enough to broadcast.
BROADCAST_ROWS = 200_000

# Settings for sessions this project starts itself (tests, bench); a cluster session keeps its own.
LOCAL_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, memory: str = "8g", app: str = "claimloom") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", str(cores))
    for key, value in LOCAL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Scratch folders of local sessions without ``spark.checkpoint.dir`` (a running session can't be given that setting); gone at exit.
_SCRATCH: dict[str, tempfile.TemporaryDirectory] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``; a folder of its own for a local session without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster has executors of their own
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        app = spark.sparkContext.applicationId
        if app not in _SCRATCH:
            _SCRATCH[app] = tempfile.TemporaryDirectory(prefix="claimloom-")
        folder = _SCRATCH[app].name
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/claimloom/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage in a way that survives executor loss, and gives the
    planner a true size for later join decisions.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes a table that ``materialize`` wrote; ``df`` can't be read after it."""
    spark = df.sparkSession
    root = f"{shared_dir(spark).rstrip('/')}/claimloom/"
    for folder in {re.sub(r"/[^/]*$", "", f) for f in df.inputFiles()}:
        if re.sub(r"^file:/*", "/", folder).startswith(re.sub(r"^file:/*", "/", root)):  # nothing but scratch tables
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only after counting that it is small; otherwise leave it to AQE."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def broadcast_bounded(df: DataFrame, bound: int, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a table whose row count is bounded by construction (for example by a top-k)."""
    return F.broadcast(df) if bound <= max_rows else df
