"""Operator 5: shards as the leaves of a k-d tree over the documents' metadata, cut at weighted medians.

Every node of the tree holds a run of shards. It is cut along the dimension in which its documents spread widest, at the
value that leaves the left part its share of the node's bytes (the weighted median where both parts get as many shards).
The law is ``bytes``: shards have nearly equal sizes, each the document's UTF-8 bytes plus 16.

Dimensions come from the text: log of the size, lines per byte, words per byte, share of bytes beyond ASCII, and a hash.
So equal texts have equal coordinates. Documents are in order of (coordinate, text hash, id), and a cut may fall anywhere in
that order: equal texts stay together unless a shard's end falls among them, and a group larger than a shard is split.

Cuts are found for all nodes of a level at once by histograms: every pass divides the interval that holds a node's cut into
BINS and sums the bytes in each, in Spark; the driver gets at most shards x BINS sums, whatever the number of documents.
A cut is done when it is between two documents or off by at most TOLERANCE of a shard. The metadata lies in the
shared folder; texts are read once.

Slots number a shard's documents from 0 without gaps. They are counted within (shard, range of a hash of the id) first, and offsets
of the ranges are added, so a shard is not gathered in one task.

Defined cases: null and empty texts have 16 bytes and the checksum of no bytes; a null id sorts first; repeated rows are
separate rows and may share coordinates and id, then the order between them is arbitrary but each gets a slot of its own; an empty table
gives an empty result; with fewer documents than shards some shards are empty. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import Stored

SHARDS, EXTRA, BINS, TOLERANCE, SLOT_ROWS = 40, 16, 512, 0.0005, 50_000
DIMENSIONS = ("d_size", "d_lines", "d_words", "d_foreign", "d_hash")
LEAST, MOST = -(1 << 63), (1 << 63) - 1
INTERVAL = "node int, dimension int, level int, low_x double, high_x double, fixed_x double, fixed_h long, low_k long, high_k long, width long"
CUT = "node int, dimension int, cut_x double, cut_h long, cut_i long, right int"


def metadata(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32``, the coordinates (0 to 1), and the two tie-breaking numbers."""
    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("long")
    share = lambda n: F.least(F.lit(1.0), n / F.greatest(size, F.lit(1)))
    count = lambda c: F.length(text) - F.length(F.translate(text, c, ""))
    h = F.xxhash64(text)
    return docs.select(
        "doc_id", (size + EXTRA).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        (F.log2(size + 1) / 40).alias("d_size"), share(count("\n")).alias("d_lines"), share(count(" ")).alias("d_words"),
        share(size - F.char_length(text)).alias("d_foreign"), ((F.shiftrightunsigned(h, 11)) * 2.0**-53).alias("d_hash"),
        h.alias("h"), F.coalesce("doc_id", F.lit(LEAST)).alias("i"),
    )


class Node:
    """A run of ``n`` shards from ``first`` on; a leaf if there is one."""

    def __init__(self, first: int, n: int):
        self.first, self.n = first, n

    def children(self) -> tuple[Node, Node]:
        return Node(self.first, self.n // 2), Node(self.first + self.n // 2, self.n - self.n // 2)


class Search:
    """The interval in which one node's cut lies. Levels: coordinate, text hash, id; the values of the levels before are fixed.
    When it is done, ``cut`` holds (value, hash, id): what is less in this order goes left."""

    def __init__(self, node: Node, dimension: int, low: float, high: float, total: int, tolerance: float):
        self.node, self.dimension, self.tolerance = node, dimension, tolerance
        self.want = total * (node.n // 2) / node.n
        self.before, self.level, self.fixed = 0, 0, []
        self.low, self.high = low, high
        self.cut: tuple[float, int, int] | None = None

    def row(self) -> tuple:
        """The interval as a row of INTERVAL."""
        fixed = [*self.fixed, 0, 0][:2]
        whole = self.level > 0
        return (
            self.node.first, self.dimension, self.level, 0.0 if whole else self.low, 0.0 if whole else self.high, float(fixed[0]), int(fixed[1]),
            self.low if whole else 0, self.high if whole else 0, ((self.high - self.low) // BINS + 1) if whole else 1,
        )

    def take(self, bins: list[tuple]) -> None:
        """``bin, bytes, least, greatest`` of the bins with rows, in order: go into the bin where the wanted number of bytes is reached, or stop."""
        sums, k = self.before, 0
        while k < len(bins) - 1 and sums + bins[k][1] < self.want:
            sums, k = sums + bins[k][1], k + 1
        _, size, least, greatest = bins[k]
        if self.want - sums <= self.tolerance:
            self.cut = self._at(least)
        elif sums + size - self.want <= self.tolerance:
            self.cut = self._at(bins[k + 1][2]) if k + 1 < len(bins) else self._after(greatest)
        elif least < greatest:
            self.before, self.low, self.high = sums, least, greatest
        elif self.level < 2:
            self.before, self.fixed, self.level = sums, [*self.fixed, least], self.level + 1
            self.low, self.high = LEAST, MOST
        else:  # rows that are alike in everything: the nearer side
            self.cut = self._at(least) if self.want - sums <= sums + size - self.want else self._after(least)

    def _at(self, value) -> tuple[float, int, int]:
        return (*self.fixed, value, LEAST, LEAST)[:3]

    def _after(self, value) -> tuple[float, int, int]:
        """Just above a value that is the last of its interval."""
        return (*self.fixed, value, MOST, MOST)[:3] if self.level < 2 else (*self.fixed, min(value + 1, MOST))


def _coordinate() -> Column:
    return F.element_at(F.array(*DIMENSIONS), F.col("dimension") + 1)


def _histograms(meta: DataFrame, searches: list[Search]) -> dict[int, list[tuple]]:
    """For each node ``bin, bytes, least, greatest`` of the bins of its interval that have rows, in order."""
    spark = meta.sparkSession
    intervals = F.broadcast(spark.createDataFrame([s.row() for s in searches], INTERVAL))  # one row a node, so SHARDS at most
    x, level = _coordinate(), F.col("level")
    key = F.when(level == 1, F.col("h")).otherwise(F.col("i"))
    fixed = (x == F.col("fixed_x")) & ((level == 1) | (F.col("h") == F.col("fixed_h")))
    inside = F.when(level == 0, (x >= F.col("low_x")) & (x <= F.col("high_x"))).otherwise(fixed & (key >= F.col("low_k")) & (key <= F.col("high_k")))
    part = (x - F.col("low_x")) / F.greatest(F.col("high_x") - F.col("low_x"), F.lit(1e-300)) * BINS
    wide = lambda c: c.cast("decimal(20,0)")
    place = F.when(level == 0, F.floor(part)).otherwise(F.floor((wide(key) - wide(F.col("low_k"))) / wide(F.col("width")))).cast("int")
    rows = meta.join(intervals, "node").where(inside).select("node", "level", "size", x.alias("x"), key.alias("k"), F.least(F.lit(BINS - 1), place).alias("bin"))
    ends = [F.min("x"), F.max("x"), F.min("k"), F.max("k")]
    out: dict[int, list[tuple]] = {}
    for node, level, bin_, size, *values in rows.groupBy("node", "level", "bin").agg(F.sum("size"), *ends).collect():
        out.setdefault(node, []).append((bin_, size, *(values[2:] if level else values[:2])))
    return {node: sorted(bins) for node, bins in out.items()}


def leaves(meta: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``meta`` with ``node``, the number of its leaf of the k-d tree. The table is written anew once a level, six times for 40 shards."""
    now = Stored(meta.withColumn("node", F.lit(0)), "shards")
    open_, scale, whole = [Node(0, shards)] if shards > 1 else [], {}, 0
    while open_:
        spread = [f(c).alias(f"{n}_{c}") for c in DIMENSIONS for n, f in (("lo", F.min), ("hi", F.max), ("sd", F.stddev_pop))]
        facts = {r["node"]: r for r in now.df.groupBy("node").agg(F.sum("size").alias("size"), *spread).collect()}
        if not scale and facts:
            whole, scale = facts[0]["size"], {c: facts[0][f"sd_{c}"] or 1.0 for c in DIMENSIONS}
        searches = []
        for node in open_:
            if r := facts.get(node.first):  # else it has no documents
                # widest: by standard deviation, as a share of that over all documents
                widest = max(DIMENSIONS, key=lambda c: r[f"sd_{c}"] / scale[c])
                searches.append(Search(node, DIMENSIONS.index(widest), r[f"lo_{widest}"], r[f"hi_{widest}"], r["size"], TOLERANCE * whole / shards))
        todo = searches
        while todo:
            bins = _histograms(now.df, todo)
            for s in todo:
                s.take(bins[s.node.first])
            todo = [s for s in todo if s.cut is None]
        if searches:
            rows = [(s.node.first, s.dimension, *s.cut, s.node.children()[1].first) for s in searches]
            cuts = F.broadcast(meta.sparkSession.createDataFrame(rows, CUT))
            x = _coordinate()
            at = F.col("h") == F.col("cut_h")
            left = (x < F.col("cut_x")) | ((x == F.col("cut_x")) & ((F.col("h") < F.col("cut_h")) | (at & (F.col("i") < F.col("cut_i")))))
            node = F.when(F.col("right").isNull() | left, F.col("node")).otherwise(F.col("right"))
            after = Stored(now.df.join(cuts, "node", "left").select(*meta.columns, node.alias("node")), "shards")
            now.drop()
            now = after
        open_ = [c for node in open_ for c in node.children() if c.n > 1]
    return now.df


def assigned(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``."""
    meta = leaves(metadata(docs), shards)
    rows = meta.count()
    ranges = max(1, -(-rows // (shards * SLOT_ROWS)))
    placed = meta.select("doc_id", "size", "text_crc32", F.col("node").alias("shard"), F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(ranges)).alias("range"))
    counts = placed.groupBy("shard", "range").agg(F.count("*").alias("n"))
    offsets = counts.withColumn("offset", F.sum("n").over(Window.partitionBy("shard").orderBy("range")) - F.col("n"))
    inner = F.row_number().over(Window.partitionBy("shard", "range").orderBy("doc_id", "text_crc32"))
    numbered = placed.withColumn("place", inner).join(offsets.drop("n"), ["shard", "range"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("offset") + F.col("place") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
