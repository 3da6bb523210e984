"""Operator 8: near-duplicate documents by BagMinHash signatures, banding, and exact overlap of shingle multisets.

A document is the multiset of its runs of five words. Two documents are linked if the weighted Jaccard similarity of their
multisets (sum of the smaller counts over sum of the larger ones) is 0.8 or more. Classes are what links connect.

Signature. The weight axis of every shingle is cut at 1, 2, 4, 8, ...; each strip carries a Poisson process in time whose
rate is the strip's width, seeded by shingle and strip alone. Each point falls on a uniform component of the signature and a
uniform weight in its strip, and counts if that weight is within the shingle's count. A component keeps the earliest point
it gets. How many points are made at once depends on the other texts at hand, the points and their times do not, to the last
bit: copies that are read in different slices or files get the same signature. Two documents agree in a component with probability equal to their weighted Jaccard similarity. Points come in the
order of time, so a strip is done once its next point is later than the latest component: little more than one point per
shingle is made. With 24 bands of 5 components, a pair at 0.8 is found with probability 0.9999.

Search. Equal texts are collapsed first (digest, smallest id). Buckets with the same members are taken once. The
members of a bucket come together with their multisets: a bucket of more than BLOCK members, or of more than BLOCK_BYTES of multisets,
is split by hash into blocks and every two blocks meet, so a task holds about twice BLOCK_BYTES, or two texts that are larger
by themselves. A task skips pairs whose signatures agree in too few components (four standard deviations below
the threshold) and pairs that are connected already, checks the others on the exact multisets, and hands on links only,
fewer than it has members. No pairs are written out.

Defined cases: null and empty texts, and texts without words, are classes of their own; a text of fewer than five words is
one run of all its words; repeated rows share their class; rows that share an id are one document, even where their texts differ:
every one of these texts is searched with, and what links with one of them is in the class of all; rows without ``doc_id`` get a null class and link with nothing;
an empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import Stored, bounded, components, slices
from claimloom.llm.words import STEP, mix, shingles
from claimloom.operators.keyed import lookup

WORDS, SIMILARITY, BANDS, ROWS, BLOCK, BLOCK_BYTES = 5, 0.8, 24, 5, 1024, 32_000_000
#: Ids up to this count are broadcast to filter the texts (8 bytes each); beyond, the texts are joined by shuffle.
BROADCAST_IDS = 4_000_000


def multisets(texts: list[str], n: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``(row, shingle)`` of all texts with their counts, ordered by row and shingle."""
    found, row = shingles(texts, n)
    order = np.lexsort((found, row))
    found, row = found[order], row[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    return row[first], found[first], np.diff(np.append(first, len(found)))


def _uniform(x: np.ndarray) -> np.ndarray:
    """From the upper bits, in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


def signatures(row: np.ndarray, shingle: np.ndarray, count: np.ndarray, rows: int, size: int) -> np.ndarray:
    """Earliest points, an array of shape (rows, size); rows without shingles have infinities only."""
    who, base, width, seed, limit = [], [], [], [], []
    low, strip = 0, 0
    left = np.arange(len(row))
    while len(left):
        wide = max(1, low)
        who.append(row[left])
        base.append(np.full(len(left), float(low)))
        width.append(np.full(len(left), float(wide)))
        seed.append(mix(shingle[left] ^ np.uint64(mix(np.array([strip], np.uint64))[0])))
        limit.append(count[left].astype(np.float64))
        low, strip = low + wide, strip + 1
        left = left[count[left] > low]
    sig = np.full((rows, size), np.inf)
    if not who:
        return sig
    who, base, width, seed, limit = map(np.concatenate, (who, base, width, seed, limit))
    latest = np.full(rows, np.inf)
    time, active, step = np.zeros(len(who)), np.arange(len(who)), 0
    flat = sig.reshape(-1)
    while len(active):
        many = 1 if step < 2 and len(active) > 4096 else int(max(1, min(64, 16384 // len(active))))
        jumps = np.arange(step, step + many, dtype=np.uint64) * np.uint64(3)
        of = seed[active][:, None] + jumps[None, :] * np.uint64(STEP)
        gaps = -np.log(_uniform(mix(of))) / width[active][:, None]
        times = np.cumsum(np.concatenate((time[active][:, None], gaps), axis=1), axis=1)[:, 1:]  # summed one by one: the same bits wherever a step ends
        place = base[active][:, None] + _uniform(mix(of + np.uint64(STEP))) * width[active][:, None]
        part = (mix(of + np.uint64(2 * STEP % (1 << 64))) >> np.uint64(32)) % np.uint64(size)
        good = (place <= limit[active][:, None]) & (times < latest[who[active]][:, None])
        at = (who[active].astype(np.int64)[:, None] * size + part.astype(np.int64))[good]
        np.minimum.at(flat, at, times[good])
        touched = np.unique(who[active])
        latest[touched] = sig[touched].max(1)
        time[active] = times[:, -1]
        step += many
        active = active[time[active] < latest[who[active]]]
    return sig


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per row and band; the band's number is part of it."""
    bits = sig.view(np.uint64).reshape(len(sig), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(sig), bands)).copy()
    for k in range(rows):
        key = mix(key ^ bits[:, :, k])
    return key.view(np.int64)


#: What a task holds for each distinct shingle: its hash and its count.
SHINGLE_BYTES = 16


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode(), digest_size=16).digest()


def _signed(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, bytes, bands``; ``bytes`` is the size of the multiset; null but for the id for texts without words."""

    def run(batches):
        for batch in slices(batches, 2048, 2_000_000):
            texts = [t or "" for t in batch["text"].to_pylist()]
            row, shingle, count = multisets(texts)
            keys = band_keys(signatures(row, shingle, count, len(texts), BANDS * ROWS))
            size = np.bincount(row, minlength=len(texts)) * SHINGLE_BYTES
            has = size > 0
            digests = [_digest(t) if h else None for t, h in zip(texts, has)]
            bands = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(has * BANDS))).astype(np.int32), pa.array(keys[has].ravel()), mask=pa.array(~has))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(digests, pa.binary()), pa.array(size, pa.int64(), mask=~has), bands], ["doc_id", "digest", "bytes", "bands"])

    return docs.select("doc_id", "text").transform(bounded).mapInArrow(run, "doc_id long, digest binary, bytes long, bands array<long>")


def _contents(docs: DataFrame, ids: DataFrame, repeated: DataFrame) -> DataFrame:
    """``rep, t, size, data, marks`` of the documents named in ``ids(doc_id)``, once for each text; ``repeated(doc_id)`` are ids of several
    rows. ``t`` is a hash of the text's digest; ``data`` holds the multiset's shingles in order, then their counts if any is over one; ``marks``
    16 bits of each component of the signature."""

    def run(batches):
        for batch in slices(batches, 1024, 1_500_000):
            texts = [t or "" for t in batch["text"].to_pylist()]
            row, shingle, count = multisets(texts)
            at = np.searchsorted(row, np.arange(len(texts) + 1))
            data, size = [], []
            for k in range(len(texts)):
                own = slice(at[k], at[k + 1])
                data.append(shingle[own].tobytes() + (count[own].astype("<u4").tobytes() if (count[own] > 1).any() else b""))
                size.append(at[k + 1] - at[k])
            sig = signatures(row, shingle, count, len(texts), BANDS * ROWS)
            marks = [m.tobytes() for m in (mix(sig.view(np.uint64)) >> np.uint64(48)).astype("<u2")]
            digests = pa.array([_digest(t) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], digests, pa.array(size, pa.int32()), pa.array(data, pa.binary()), pa.array(marks, pa.binary())], ["rep", "digest", "size", "data", "marks"])

    texts = docs.select("doc_id", "text").join(_small(ids), "doc_id", "left_semi")
    if not repeated.isEmpty():
        again = _small(repeated.join(ids, "doc_id", "left_semi"))
        once = texts.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
        texts = texts.join(again, "doc_id", "left_anti").union(once)
    found = texts.transform(bounded).mapInArrow(run, "rep long, digest binary, size int, data binary, marks binary").where("size > 0")
    return found.select("rep", F.xxhash64("digest").alias("t"), "size", "data", "marks")


def _small(ids: DataFrame) -> DataFrame:
    """``ids``, to be broadcast if they were counted to be few."""
    return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids


def jaccard(a: tuple[np.ndarray, np.ndarray], others: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Weighted Jaccard similarities of one multiset with others; shingles are in order."""
    hashes, counts = (np.concatenate([x[k] for x in others]) for k in (0, 1))
    at = np.minimum(np.searchsorted(a[0], hashes), len(a[0]) - 1)
    common = np.where(a[0][at] == hashes, np.minimum(a[1][at], counts), 0)
    begin = np.cumsum([0, *(len(x[0]) for x in others[:-1])])
    both = np.add.reduceat(common, begin)
    return both / (a[1].sum() + np.add.reduceat(counts, begin) - both)


class Bucket:
    """The members of one bucket (or of two blocks of one) that a task has gathered."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.side: list[int] = []
        self.sets: list[tuple[np.ndarray, np.ndarray]] = []
        self.marks: list[np.ndarray] = []

    def add(self, rep: int, side: int, size: int, data: bytes, marks: bytes) -> None:
        self.ids.append(rep)
        self.side.append(side)
        counts = np.frombuffer(data, "<u4", size, 8 * size).astype(np.int64) if len(data) > 8 * size else np.ones(size, np.int64)
        self.sets.append((np.frombuffer(data, "<u8", size), counts))
        self.marks.append(np.frombuffer(marks, "<u2"))

    def links(self, similarity: float, many: int = 64) -> list[tuple[int, int]]:
        """Links that connect what all links of this bucket connect. With two blocks, only pairs across them are looked at."""
        marks, side, out = np.array(self.marks), np.array(self.side), []
        group = np.arange(len(marks))
        least = similarity - 4 * np.sqrt(similarity * (1 - similarity) / marks.shape[1])
        two = len(set(self.side)) > 1
        for i in range(1, len(marks)):
            alike = (marks[:i] == marks[i]).mean(1)
            left = np.flatnonzero((alike >= least) & ((side[:i] != side[i]) | (not two)))
            left = left[np.argsort(-alike[left], kind="stable")]
            while len(left := left[group[left] != group[i]]):
                now, left = left[:many], left[many:]
                for j in now[jaccard(self.sets[i], [self.sets[j] for j in now]) >= similarity - 1e-12]:
                    if group[j] != group[i]:
                        out.append((self.ids[i], self.ids[j]))
                        group[group == group[i]] = group[j]
        return out


def _links(members: DataFrame, contents: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: links inside the buckets ``members(key, part, side, rep, t)``."""

    def run(batches):
        key, bucket = None, Bucket()
        for batch in slices(batches, 1024, 16_000_000):
            out: list[tuple[int, int]] = []
            for *new, side, rep, size, data, marks in zip(*(c.to_pylist() for c in batch.columns)):
                if new != key:
                    out += bucket.links(similarity) if len(bucket.ids) > 1 else []
                    key, bucket = new, Bucket()
                bucket.add(rep, side, size, data, marks)
            yield _pairs(out)
        yield _pairs(bucket.links(similarity) if len(bucket.ids) > 1 else [])

    rows = members.join(contents, ["rep", "t"]).repartition("key", "part").sortWithinPartitions("key", "part", "rep", "t")
    return rows.select("key", "part", "side", "rep", "size", "data", "marks").transform(bounded).mapInArrow(run, "a long, b long")


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id, kept``: one row per row of ``docs``; ``class_id`` is the smallest id of the class, ``kept`` says that it is the row's own."""
    signed = Stored(_signed(docs), "signed")
    known = signed.df.where("doc_id is not null and digest is not null")
    # a text's hash tells the texts of one id apart; what hangs on the text alone is the same in all its rows
    copies = known.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.any_value("bytes").alias("bytes"), F.any_value("bands").alias("bands"))
    every = copies.select(F.explode("bands").alias("key"), "rep", F.xxhash64("digest").alias("t"), "bytes")
    # Buckets with the same members say the same; one of them is kept. The members are compared by two hashes, their number and size.
    mark = [F.bit_xor(F.xxhash64("rep", "t")).alias("x"), F.bit_xor(F.xxhash64("rep", "t", F.lit(1))).alias("y")]
    buckets = every.groupBy("key").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"), *mark).where("n > 1")
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES))
    single = buckets.groupBy("n", "bytes", "x", "y").agg(F.min("key").alias("key")).select("key", F.least("n", blocks).alias("blocks"))
    members = Stored(every.drop("bytes").join(single, "key"), "members")
    block = F.pmod(F.xxhash64("rep", "t", F.lit(2)), F.col("blocks"))
    meeting = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct((F.least(k, block) * F.col("blocks") + F.greatest(k, block)).alias("part"), F.when(k == block, 0).otherwise(F.signum(block - k)).cast("int").alias("side")))
    placed = members.df.select("key", "rep", "t", F.explode(meeting).alias("m")).select("key", "m.part", "m.side", "rep", "t")
    t = F.xxhash64("digest")  # of a text without words: a fixed number
    several = signed.df.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), (F.min(t) < F.max(t)).alias("clash"))
    repeated = Stored(several.where("n > 1"), "repeated")
    contents = _contents(docs, members.df.select(F.col("rep").alias("doc_id")).distinct(), repeated.df.select("doc_id"))
    links = Stored(_links(placed, contents, similarity).union(_same_id(known, repeated.df, copies.select("digest", "rep"))), "links")
    out = Stored(_result(signed.df, copies, components(links.df)), "classes")
    for table in (signed, members, repeated, links):
        table.drop()
    return out.df


def _same_id(known: DataFrame, repeated: DataFrame, copies: DataFrame) -> DataFrame:
    """``a, b``: links of ids whose rows differ in text with the representatives of these texts."""
    clash = repeated.where("clash").select("doc_id")
    if clash.isEmpty():
        return known.sparkSession.createDataFrame([], "a long, b long")
    rows = lookup(known.select("doc_id", "digest"), clash, "doc_id", ["digest"]).distinct()
    return rows.join(copies, "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))


def _result(signed: DataFrame, copies: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with a text to go by get the class of the text, the others that of their id, if its other rows have one."""
    of = copies.join(groups.withColumnRenamed("id", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("class_id"))
    worded = F.col("doc_id").isNotNull() & F.col("digest").isNotNull()
    by_text = signed.where(worded).join(of, "digest").select("doc_id", "class_id")
    by_id = signed.where(~worded).select("doc_id").join(groups.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    rows = by_text.union(by_id.select("doc_id", F.coalesce("component", "doc_id")))
    return rows.select("doc_id", "class_id", F.coalesce(F.col("class_id") == F.col("doc_id"), F.lit(False)).alias("kept"))
