"""Operator 3: near-duplicate embeddings by spherical-cap filters.

A filter is a direction on the sphere, and a vector passes it if it lies in the cap around it. The directions are a
random product code: vectors are rotated and cut into ``PARTS`` parts, each part has a list of random unit vectors, and every
combination of one from each list is a direction. So a vector's scores with all directions are sums of its scores with the
short lists, and the directions it exceeds are decoded from these lists part by part, without visiting all combinations. There
are about as many directions as vectors. The cap's height is set for each vector so that it exceeds PASSED directions: with one
height for all, vectors whose length is uneven over the parts would pass none. At cosine 0.95 exactly, 999 of 1000 pairs
share a filter with 50,000 vectors, 97 of 100 with 10^8 (measured; closer pairs more often).

Vectors that are equal once they have length one are compared once, with their number as a weight, and all get the result.
Vectors meet by filter. A filter with many vectors is split into blocks and every two blocks meet, so a task holds twice BLOCK
vectors at most. Cosines are in double precision. A pair counts in the smallest filter that both passed, so it counts
once; tasks hand on one count per vector and one edge per connected vector, never pairs.

Defined cases: vectors that are null, zero, or hold null or non-finite components link with nothing and are components of
their own; vectors of different lengths never meet. An id
names one vector: of rows with the same id the smallest vector is compared, and all of them get its result. Rows without an id get 0 links, no component,
and aren't kept. An empty table gives an empty result. Only the id and the vector are read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import Stored, bounded, components, slices
from claimloom.operators.keyed import lookup

COSINE, PARTS, PASSED, LEAST_LIST, BLOCK, COLUMNS, SEED = 0.95, 3, 24, 16, 1024, 4096, 20_250_101


class Code:
    """Rotation and short lists for one dimension and about ``n`` vectors."""

    def __init__(self, dimension: int, n: int):
        rng = np.random.default_rng(SEED + dimension)
        self.size = max(LEAST_LIST, int(np.ceil(n ** (1 / PARTS))))
        self.turn = np.linalg.qr(rng.normal(size=(dimension, dimension)))[0] if dimension <= 4096 else None
        self.cuts = np.linspace(0, dimension, min(PARTS, dimension) + 1).astype(int)
        self.lists = []
        for a, b in zip(self.cuts, self.cuts[1:]):
            list_ = rng.normal(size=(self.size, b - a))
            self.lists.append(list_ / np.linalg.norm(list_, axis=1, keepdims=True) * np.sqrt((b - a) / dimension))

    def filters(self, vectors: np.ndarray) -> list[np.ndarray]:
        """For each unit vector the numbers of the directions that it exceeds, in order."""
        turned = vectors @ self.turn if self.turn is not None else vectors
        scores = [turned[:, a:b] @ list_.T for (a, b), list_ in zip(zip(self.cuts, self.cuts[1:]), self.lists)]
        most = min(self.size, PASSED)
        out = []
        for k in range(len(vectors)):
            total, number = np.zeros(1), np.zeros(1, np.int64)
            for score in scores:  # of partial sums that end alike, only the best can be part of the best whole sums
                own = np.argpartition(-score[k], most - 1)[:most]
                total = np.add.outer(total, score[k][own]).ravel()
                number = np.add.outer(number * self.size, own).ravel()
                if len(total) > PASSED:
                    best = np.argpartition(-total, PASSED - 1)[:PASSED]
                    total, number = total[best], number[best]
            out.append(np.sort(number))
        return out


@lru_cache(maxsize=4)
def code(dimension: int, n: int) -> Code:
    return Code(dimension, n)


def _met(
    ids: np.ndarray, side: np.ndarray, weight: np.ndarray, vectors: np.ndarray, filters: list[np.ndarray], number: int, cosine: float
) -> tuple[np.ndarray, np.ndarray]:
    """For the vectors that met at one filter: how many links each has that count here, and the smallest id that each is connected to by them."""
    n = len(ids)
    linked = np.zeros((n, n), bool)
    for lo in range(0, n, 512):
        linked[lo : lo + 512] = vectors[lo : lo + 512] @ vectors.T >= cosine
    np.fill_diagonal(linked, False)
    # a pair counts at the first filter that both exceed: filters that two or more of them exceed are looked at, COLUMNS at a time
    before = [f[f < number] for f in filters]
    owner = np.repeat(np.arange(n), [len(f) for f in before])
    _, place, times = np.unique(np.concatenate(before), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)
    for at in range(0, len(shared) if linked.any() else 0, COLUMNS):
        column = np.full(len(times), -1)
        column[shared[at : at + COLUMNS]] = np.arange(len(shared[at : at + COLUMNS]))
        held = column[place] >= 0
        passed = np.zeros((n, len(shared[at : at + COLUMNS])), np.float32)
        passed[owner[held], column[place[held]]] = 1
        for lo in range(0, n, 512):
            linked[lo : lo + 512] &= passed[lo : lo + 512] @ passed.T < 0.5
    if len(np.unique(side)) > 1:
        linked &= side[:, None] != side[None, :]
    root, left = np.full(n, -1), np.flatnonzero(linked.any(1))
    for k in left[np.argsort(ids[left], kind="stable")]:
        if root[k] < 0:
            reached = np.zeros(n, bool)
            front = np.array([k])
            while len(front):
                reached[front] = True
                front = np.flatnonzero(linked[front].any(0) & ~reached)
            root[reached] = k
    return linked @ weight, np.where(root >= 0, ids[root], ids)


def links(vectors: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept``: one row per row of ``vectors``."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    valid = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    usable = rows.where(F.col("id").isNotNull() & valid)
    if not usable.groupBy("id").count().where("count > 1").isEmpty():
        usable = usable.groupBy("id").agg(F.min("v").alias("v"))
    total = usable.count()

    def spread(batches):
        for batch in slices(batches, 2048):
            values = batch["v"].to_pylist()
            ids = batch["id"].to_pylist()
            by_length: dict[int, list[int]] = {}
            for k, v in enumerate(values):
                by_length.setdefault(len(v), []).append(k)
            for length, own in by_length.items():
                x = np.array([values[k] for k in own])
                x = x / np.abs(x).max(1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                found = code(length, total).filters(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[k] for k in own], pa.int64()), pa.array([length] * len(own), pa.int32()), pa.array(found, pa.list_(pa.int64())), pa.array([r.tobytes() for r in x], pa.binary())],
                    ["id", "length", "filters", "x"],
                )

    every = Stored(usable.transform(bounded).mapInArrow(spread, "id long, length int, filters array<long>, x binary"), "caps")
    # vectors that are equal once they have length one meet others through the one with the smallest id, which counts for all of them
    alike = every.df.groupBy(F.sha2("x", 256).alias("digest")).agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    copies = Stored(alike.where("n > 1"), "copies").df
    numbered = lookup(every.df.withColumn("digest", F.sha2("x", 256)), copies.select("digest", "rep", F.col("n").alias("weight")), "digest", ["id"], "left", counts=copies.select("digest", "n"))
    numbered = numbered.withColumn("rep", F.coalesce("rep", "id")).withColumn("weight", F.coalesce("weight", F.lit(1)))
    placed = Stored(numbered.where("id = rep").select("id", "length", "filters", "x", "weight"), "caps")
    each = placed.df.select("length", F.explode("filters").alias("filter"), "id")
    busy = each.groupBy("length", "filter").agg(F.count("*").alias("n")).where("n > 1").select("length", "filter", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    meeting = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct((F.least(k, block) * F.col("blocks") + F.greatest(k, block)).alias("part"), F.when(k == block, 0).otherwise(F.signum(block - k)).cast("int").alias("side")))
    meet = each.join(busy, ["length", "filter"]).select("length", "filter", "id", F.explode(meeting).alias("m")).select("length", "filter", "id", "m.part", "m.side")
    full = meet.join(placed.df.select("id", "weight", "filters", "x"), "id").repartition("length", "filter", "part").sortWithinPartitions("length", "filter", "part", "id")

    def match(batches):
        key, held = None, []
        for batch in slices(batches, 4096, 16_000_000):
            out = []
            for *new, ident, side, weight, filters, x in zip(*(c.to_pylist() for c in batch.columns)):
                if new != key:
                    out += _group(key, held, cosine)
                    key, held = new, []
                held.append((ident, side, weight, np.array(filters), np.frombuffer(x)))
            yield _counts(out)
        yield _counts(_group(key, held, cosine))

    counted = Stored(full.select("length", "filter", "part", "id", "side", "weight", "filters", "x").transform(bounded).mapInArrow(match, "id long, n long, root long"), "links")
    placed.drop()
    sums = counted.df.groupBy(F.col("id").alias("rep")).agg(F.sum("n").alias("n"))
    groups = components(counted.df.select(F.col("id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "rep")
    found = Stored(sums.join(groups, "rep"), "found").df
    # a vector without links but with copies is a component with them
    named = Stored(numbered.select("id", "rep", "weight"), "reps").df
    every.drop()
    counts = copies.select("rep", "n")
    alone = lookup(named, found, "rep", ["id"], "left", counts=counts).where("n is not null or weight > 1")
    alone = alone.select("id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"), F.coalesce("component", "rep").alias("component"))
    out = rows.select("id").join(alone, "id", "left")
    return out.select(
        F.col("id").alias("vec_id"), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(False)).alias("kept"),
    )


def _group(key: list | None, held: list[tuple], cosine: float) -> list[tuple[int, int, int]]:
    if len(held) < 2:
        return []
    ids, side, weight = (np.array([h[k] for h in held]) for k in range(3))
    counts, roots = _met(ids, side, weight, np.array([h[4] for h in held]), [h[3] for h in held], key[1], cosine)
    return [(int(i), int(c), int(r)) for i, c, r in zip(ids, counts, roots) if c]


def _counts(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["id", "n", "root"])
