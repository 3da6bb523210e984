"""Operator 12: what each of several filters removes, in every order of the filters, from one small tensor of counts per part.

A document fails any of five filters (``FILTERS``). Per part, documents are counted in a 2x2x2x2x2 tensor, one axis per filter
with index 0 for pass and 1 for fail; two more tensors count those with quality 1 and those that are toxic. Every figure of every
step of all 120 orders is a contraction of such a tensor: each axis is multiplied by ``PASS``, ``FAIL`` or ``ALL``. So texts are
read once, whatever number of orders is asked for.

Filter E needs the whole table: a document fails it if a document with a smaller id has the same text. Ids and digests (128
bits) of texts go through the shuffle, not texts; the smallest id of each digest is an aggregate with partial sums, and
passing documents are found by a join on digest and id together, so a text that a third of all rows share is no hot key.
Counts per part are partial sums too; each part's tensor is contracted in the task that holds its 128 numbers.

Defined cases: a null text is empty, a null source is the part with the empty string; a document without label counts in no
quality or toxic figure, and one with several label rows counts as quality (toxic) if any of them says so; rows without id never
pass E for another row and fail it if a row with an id has their text; repeated rows (same id and text) don't fail E because of
each other. An empty table gives no rows. Only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import Stored, bounded, slices

FILTERS = "ABCDE"
PASS, FAIL, ALL = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
#: ``bytes.split()`` parts words at exactly the six white characters of the filters' definition.
WORD = re.compile(rb"[^\x20\t-\r]+")
CAPITALS, MARKS = bytes(range(65, 91)), b"#$%&*|"
LATER = bytes(range(0x80, 0xC0))  # bytes that continue a code point
LONG = 1 << 20


def counted_words(data: bytes) -> tuple[int, int]:
    """Words and distinct words of a text; a long one never has all its words in memory at once."""
    if len(data) <= LONG:
        words = data.split()
        return len(words), len(set(words))
    n, seen = 0, set()
    for found in WORD.finditer(data):
        n += 1
        seen.add(found.group())
    return n, len(seen)


def fails(data: bytes) -> int:
    """Bits of the first four filters that a text fails: A 1, B 2, C 4, D 8."""
    words, distinct = counted_words(data)
    points = len(data.translate(None, LATER))
    capitals = len(data) - len(data.translate(None, CAPITALS))
    marks = len(data) != len(data.translate(None, MARKS))
    return (words < 200) + 2 * (100 * distinct < 50 * words) + 4 * (100 * capitals > 2 * points) + 8 * marks


def examined(docs: DataFrame) -> DataFrame:
    """``part, doc_id, digest, bits``: one narrow row per document."""

    def run(batches):
        for batch in slices(batches):
            digests, bits = [], []
            for data in batch["data"].to_pylist():
                digests.append(hashlib.blake2b(data or b"", digest_size=16).digest())
                bits.append(fails(data or b""))
            yield pa.RecordBatch.from_arrays(
                [batch["part"], batch["doc_id"], pa.array(digests, pa.binary()), pa.array(bits, pa.int8())], ["part", "doc_id", "digest", "bits"]
            )

    rows = docs.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("data"))
    return rows.transform(bounded).mapInArrow(run, "part string, doc_id long, digest binary, bits tinyint")


def tensors(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, cell, n, good, toxic``: how many documents of a part fail just the filters of ``cell`` (bits A 1 to E 16)."""
    narrow = Stored(examined(docs), "examined").df
    # the row with the smallest id of its text passes E; the join is on text and id together, hence without a hot key
    first = narrow.groupBy("digest").agg(F.min("doc_id").alias("first")).select(F.col("digest").alias("text_digest"), "first", F.lit(0).alias("passes"))
    same = (F.col("digest") == F.col("text_digest")) & F.col("doc_id").eqNullSafe(F.col("first"))
    cells = narrow.join(first, same, "left").select(
        "part", "digest", F.col("doc_id").alias("id"), (F.col("bits") + F.coalesce("passes", F.lit(16))).cast("int").alias("cell")
    )
    said = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    said = said.where("id is not null").withColumn("salt", F.lit(0))
    # rows without id have no label; their digests spread them
    cells = cells.withColumn("salt", F.when(F.col("id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(1024)).cast("int")).otherwise(0))
    joined = cells.join(said, ["id", "salt"], "left")
    count = [F.count("*").alias("n"), *(F.count(F.when(F.col(c), 1)).alias(c) for c in ("good", "toxic"))]
    return joined.groupBy("part", "cell").agg(*count)


def contracted(tensor: np.ndarray, passing: str, failing: str = "") -> np.ndarray:
    """For each part (first axis) the documents that pass the filters ``passing`` and fail those of ``failing``, whatever the others say."""
    vectors = [PASS if f in passing else FAIL if f in failing else ALL for f in FILTERS]
    return np.einsum("pabcde,a,b,c,d,e->p", tensor, *vectors)


def figures(all_docs: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Tensors of parts to figures: one axis each for parts, orders, steps and ``FIGURES``."""
    steps: dict[tuple[str, str], list[np.ndarray]] = {}
    for f in FILTERS:
        others = FILTERS.replace(f, "")
        failing, only = contracted(all_docs, "", f), contracted(all_docs, others, f)
        for before in itertools.chain.from_iterable(itertools.combinations(others, n) for n in range(len(FILTERS))):
            passed = "".join(before)
            removed = contracted(all_docs, passed, f)
            steps[passed, f] = [contracted(all_docs, passed + f), removed, failing - removed, only, contracted(good, passed, f), contracted(toxic, passed, f)]
    shapley = {f: np.zeros(len(all_docs), np.int64) for f in FILTERS}
    for (passed, f), values in steps.items():
        shapley[f] += math.factorial(len(passed)) * math.factorial(len(FILTERS) - 1 - len(passed)) * values[1]
    rows = [[[*steps["".join(sorted(order[:k])), f], shapley[f]] for k, f in enumerate(order)] for order in ORDERS]
    return np.moveaxis(np.array(rows, np.int64), -1, 0)


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (``source``), order and step: ``part, filter_order, step`` and the counts ``FIGURES``. ``docs`` has
    ``doc_id, text, source``, ``labels`` has ``doc_id, quality, toxic``."""
    cells = tensors(docs, labels).groupBy("part").agg(F.collect_list(F.struct("cell", "n", "good", "toxic")).alias("cells"))  # 32 at most
    per_part = len(ORDERS) * len(FILTERS)

    def run(batches):
        for batch in slices(batches):
            counts = np.zeros((3, batch.num_rows, 32), np.int64)
            for k, cells in enumerate(batch["cells"].to_pylist()):
                for c in cells:
                    counts[:, k, c["cell"]] = c["n"], c["good"], c["toxic"]
            shaped = counts.reshape(3, -1, 2, 2, 2, 2, 2).transpose(0, 1, 6, 5, 4, 3, 2)  # bit A becomes the first axis
            columns = figures(*shaped).reshape(-1, len(FIGURES)).T
            parts = batch["part"].take(pa.array(np.repeat(np.arange(batch.num_rows), per_part)))
            orders = pa.array([o for o in ORDERS for _ in FILTERS] * batch.num_rows)
            steps = pa.array(np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS) * batch.num_rows))
            yield pa.RecordBatch.from_arrays([parts, orders, steps, *map(pa.array, columns)], ["part", "filter_order", "step", *FIGURES])

    return cells.mapInArrow(run, f"part string, filter_order string, step int, {', '.join(f'{c} long' for c in FIGURES)}")
