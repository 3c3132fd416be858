"""Exact distinct counts of numbers, kept as bitmaps that can be stored and merged.

A key's numbers lie in bitmaps of 64 bits, one for each run of 64 numbers of which
it has some. Tables of bitmaps are combined by ``or``, so today's rows are added to
yesterday's bitmaps without reading yesterday's rows. A bitmap is one long, so a key of
few scattered numbers costs about what its rows do, and one of many a small part of that;
all steps are aggregates that Spark combines before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "bucket", "bits"
#: Numbers of a bitmap: 2 to this power, the bits of a long.
_SHIFT = 6


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """``keys``, ``bucket`` and the ``bits`` of the numbers of each key; NULL and negative numbers are left out."""
    rows = df.where(F.col(number) >= 0).select(*keys, F.col(number).cast("long").alias("_n"))
    at = F.col("_n").bitwiseAND((1 << _SHIFT) - 1).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at)
    placed = rows.select(*keys, F.shiftright("_n", _SHIFT).alias(BUCKET), bit.alias("_bit"))
    return placed.groupBy(*keys, BUCKET).agg(F.bit_or("_bit").alias(BITS))


def merged_bitmaps(*tables: DataFrame) -> DataFrame:
    """One row for each key and bucket of all tables."""
    both = tables[0]
    for more in tables[1:]:
        both = both.unionByName(more)
    keys = [c for c in both.columns if c != BITS]
    return both.groupBy(*keys).agg(F.bit_or(BITS).alias(BITS))


def counted_bitmaps(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """How many different numbers each key has; keys without any are absent."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bit_count(BITS)).alias(name))
