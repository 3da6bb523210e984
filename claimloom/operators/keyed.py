"""Joins on a key that a large share of the rows may hold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.session import BROADCAST_ROWS

#: A key is hot if it holds more than a PIECES-th of the rows, so there are fewer than PIECES hot keys; none is below LEAST rows.
PIECES, LEAST = 1024, 50_000
#: Columns of this module's own: no column of a caller may have these names, so that keys may be called ``n`` or ``parts``.
SALT, ROWS, PARTS = "__salt", "__rows", "__parts"


def hot_keys(counts: DataFrame, keys: list[str], pieces: int = PIECES, least: int = LEAST, n: str = "n") -> DataFrame:
    """``keys, __parts`` of the keys of ``counts(keys, n)`` that should be split, and into how many parts. Fewer than ``pieces`` rows."""
    limit = F.greatest(F.lit(least), F.ceil(counts.agg(F.sum(n)).scalar() / pieces))
    return counts.where(F.col(n) > limit).select(*keys, F.ceil(F.col(n) / limit).cast("int").alias(PARTS))


def split_join(
    left: DataFrame, right: DataFrame, keys: str | list[str], by: list[Column | str], how: str = "inner", counts: DataFrame | None = None,
    pieces: int = PIECES, least: int = LEAST,
) -> DataFrame:
    """``left`` joined to ``right`` on ``keys``, with the rows of a hot key dealt over several tasks.

    ``right`` has a row or a few per key (a model, a lexicon). Adaptive execution splits a hot partition only if the other side is a plain
    shuffle; a side that was aggregated on the key is not, so its hot keys would stay in one task. Here keys are counted first
    (``counts(keys, n)``, if known); those above a PIECES-th of all rows get a salt, from a hash of ``by`` on the left, and only
    their rows of ``right`` are repeated, once per salt: fewer than 2 * PIECES times the rows per key. ``how`` is ``inner``
    or ``left``; null keys join with nothing and, for ``left``, are spread too.
    """
    if how not in ("inner", "left"):
        raise ValueError("inner or left")
    keys = [keys] if isinstance(keys, str) else keys
    n = "n" if counts is not None else ROWS
    if counts is None:
        counts = left.groupBy(*keys).agg(F.count("*").alias(ROWS))
    no_null = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    hot = hot_keys(counts.where(no_null), keys, pieces, least, n)
    rows = hot.collect()  # fewer than PIECES
    hashed = F.xxhash64(*by)
    spread_null = F.pmod(hashed, F.lit(pieces)).cast("int")
    if not rows:
        salted = left.withColumn(SALT, F.when(no_null, F.lit(0)).otherwise(spread_null))
        return salted.join(right.withColumn(SALT, F.lit(0)), [*keys, SALT], how).drop(SALT)
    table = F.broadcast(left.sparkSession.createDataFrame(rows, hot.schema))
    parts = F.coalesce(PARTS, F.lit(1))
    salted = left.join(table, keys, "left").withColumn(SALT, F.when(no_null, F.pmod(hashed, parts).cast("int")).otherwise(spread_null)).drop(PARTS)
    repeated = right.join(table, keys, "left").withColumn(SALT, F.explode(F.sequence(F.lit(0), parts - 1))).drop(PARTS)
    return salted.join(repeated, [*keys, SALT], how).drop(SALT)


def lookup(left: DataFrame, right: DataFrame, keys: str | list[str], by: list[Column | str], how: str = "inner", most: int = BROADCAST_ROWS, counts: DataFrame | None = None) -> DataFrame:
    """``split_join``, or a broadcast of ``right`` where it was counted to have ``most`` rows at most; ``right`` should be stored."""
    if right.limit(most + 1).count() <= most:
        return left.join(F.broadcast(right), keys, how)
    return split_join(left, right, keys, by, how, counts)
