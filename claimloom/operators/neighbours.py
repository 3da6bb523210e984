"""Nearest vectors by cosine for many vectors at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors compared at once: the products of two blocks are BLOCK * BLOCK numbers.
BLOCK = 1024
#: So many queries at most are broadcast, and the table's vectors stay where they are.
FEW = 4 * BLOCK


def usable(table: DataFrame, key: str, vector: str) -> DataFrame:
    """``key, v, n``: vectors with their norms; those that are null, or not finite, or zero are left out."""
    values = F.col(vector).cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda a, x: a + x * x))
    some = table.where(F.col(vector).isNotNull() & F.col(key).isNotNull()).where(~bad).withColumn("_n", norm).where("_n > 0")
    # the norm goes beside the vector: inside a lambda it would be computed again for every component
    return some.select(F.col(key).alias("key"), values.alias("v"), F.col("_n").alias("n"))


def blocks(table: DataFrame, key: str, vector: str, rows: int = BLOCK) -> DataFrame:
    """``block, keys, vectors, norms``: the rows of ``table`` in blocks of about ``rows``, by a hash of the key; vectors that are null, or not finite, or zero are left out."""
    n = max(1, -(-table.count() // rows))
    row = F.struct("key", "v", "n").alias("row")
    rows_of = usable(table, key, vector).select(F.pmod(F.xxhash64("key"), F.lit(n)).cast("int").alias("block"), row)
    gathered = rows_of.groupBy("block").agg(F.collect_list("row").alias("rows"))
    return gathered.select("block", F.col("rows.key").alias("keys"), F.col("rows.v").alias("vectors"), F.col("rows.n").alias("norms"))


def stretches(table: DataFrame, key: str, vector: str, rows: int = BLOCK) -> DataFrame:
    """``keys, vectors, norms``: the same rows in blocks of ``rows`` at most as they lie in their partitions, so that no vector is moved."""
    kind = table.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                some = batch.slice(at, rows)
                columns = [pa.ListArray.from_arrays(pa.array([0, some.num_rows], "int32"), pa.concat_arrays([some[c]])) for c in ("key", "v", "n")]
                yield pa.RecordBatch.from_arrays(columns, ["keys", "vectors", "norms"])

    return usable(table, key, vector).mapInArrow(cut, f"keys array<{kind}>, vectors array<array<double>>, norms array<double>")


def neighbours(table: DataFrame, queries: DataFrame, key: str, vector: str, k: int = 10, block: int = BLOCK) -> DataFrame:
    """``query, key, similarity, rank``: the ``k`` vectors of ``table`` nearest to each vector of ``queries``, other than itself.

    Both have ``key`` and ``vector``. Every block of queries meets every block of the table as one matrix product; what leaves
    the task is the first ``k`` of each query. Of the vectors only those of a few queries come to the driver, to be broadcast. Ties
    at nine places go to the smaller key.
    """
    kind = table.schema[key].dataType.simpleString()
    asked = blocks(queries, key, vector, block).select(F.col("block").alias("asked"), F.col("keys").alias("qkeys"), F.col("vectors").alias("qvectors"), F.col("norms").alias("qnorms"))
    if queries.limit(FEW + 1).count() <= FEW:
        pairs = stretches(table, key, vector, block).crossJoin(F.broadcast(asked))
    else:
        parts = max(1, -(-queries.count() // block))
        pairs = blocks(table, key, vector, block).withColumn("asked", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).join(asked, "asked")
    pairs = pairs.select("keys", "vectors", "norms", "qkeys", "qvectors", "qnorms")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                keys, vectors, qkeys, qvectors = (batch[c][row] for c in ("keys", "vectors", "qkeys", "qvectors"))
                names, asks = keys.values, qkeys.values
                qnorms, norms = (batch[c][row].values.to_numpy()[:, None] for c in ("qnorms", "norms"))
                a, b = (v.values.flatten().to_numpy().reshape(len(v), -1) / n for v, n in ((qvectors, qnorms), (vectors, norms)))
                score = np.round(a @ b.T, 9)
                same = {x: i for i, x in enumerate(names.to_pylist())}
                own = [(q, same[x]) for q, x in enumerate(asks.to_pylist()) if x in same]
                if own:
                    score[tuple(np.array(own).T)] = -2.0
                order = np.argsort(np.argsort(np.array(names.to_pylist(), dtype=object), kind="stable"), kind="stable")
                best = np.lexsort((np.broadcast_to(order, score.shape), -score), axis=1)[:, :k]
                q = np.repeat(np.arange(len(a)), best.shape[1])
                value = score[q, best.ravel()]
                keep = value > -2.0
                yield pa.RecordBatch.from_arrays([asks.take(pa.array(q[keep])), names.take(pa.array(best.ravel()[keep])), pa.array(value[keep])], ["query", "key", "similarity"])

    found = pairs.mapInArrow(run, f"query {kind}, key {kind}, similarity double")
    order = Window.partitionBy("query").orderBy(F.desc("similarity"), "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
