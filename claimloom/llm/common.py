"""What several of these operators share: reading, Arrow batches, deleting scratch tables, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.operators.keyed import split_join
from claimloom.session import fresh_path

SLICE = 256


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller pieces, so that few Python strings live at a time: at most ``rows`` rows,
    and at most ``most`` bytes unless a single row is larger."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            n = min(rows, batch.num_rows - at)
            while n > 1 and batch.slice(at, n).get_total_buffer_size() and _bytes(batch.slice(at, n)) > most:
                n //= 2
            yield batch.slice(at, n)
            at += n


def _bytes(batch: pa.RecordBatch) -> int:
    return batch.nbytes


def bounded(df: DataFrame) -> DataFrame:
    """``df``, after setting what goes to a Python worker at once to a few megabytes; else it is 10,000 rows of any length."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return df


def dropped(spark: SparkSession, folder: str) -> None:
    """Deletes a scratch folder in the shared folder, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Stored:
    """A table written once to the shared folder and read back; ``drop`` deletes it when nothing reads it any more."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = fresh_path(self.spark, name)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        dropped(self.spark, self.path)


#: An id with more neighbours than this, and than a thousandth of all edges, has them dealt over several tasks.
HUB = 500


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of ``edges(a, b)``: one row ``(id, component)`` per id that has an edge, where
    ``component`` is the smallest id that it reaches.

    Alternates the large-star and small-star steps: every id is joined to the smallest id of its neighbourhood, until
    nothing changes. The smallest neighbour is an aggregate with partial sums, which counts the neighbours too; where it comes back
    to them, those of a hub are dealt over several tasks. Tables between steps lie in the shared folder.
    """
    now = Stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "components"
    )
    before = None
    while True:
        both = now.df.union(now.df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = Stored(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("u", "m")), "components")
        # large star: neighbours above u go to the smallest of the neighbourhood
        met = split_join(both.where("v > u"), least.df.select("u", "m"), "u", ["v"], counts=least.df.select("u", "n"), least=HUB)
        large = Stored(met.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"), "components")
        # small star: neighbours below u, and u itself, go to the smallest
        low = Stored(large.df.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "components")
        met = split_join(large.df, low.df.select("u", "m"), "u", ["v"], counts=low.df.select("u", "n"), least=HUB)
        pairs = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
        after = Stored(met.select(F.explode(pairs).alias("e")).select("e.u", "e.v").where("u <> v").distinct(), "components")
        n, total, check = after.df.agg(F.count("*"), F.sum(F.col("v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("u", "v"))).first()
        for table in (now, least, large, low):
            table.drop()
        now = after
        if (n, total, check) == before:
            return now.df.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                now.df.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        before = (n, total, check)
