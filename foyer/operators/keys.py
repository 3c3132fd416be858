"""Dense surrogate keys without a single-task numbering step."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoints

#: Keys kept free above the highest one given out.
RESERVE = 10

_IN_PARTITION = 33  # bits of monotonically_increasing_id() below the partition number


def surrogate_key(
    df: DataFrame, natural: str, key: str, base: int = 100_000
) -> tuple[DataFrame, DataFrame]:
    """Number the distinct non-NULL values of ``natural`` from ``base + 1`` in their order.

    Returns ``(natural, key)`` and a one-row frame ``(next_id)`` that leaves a
    reserve. The values are range-partitioned and sorted inside their
    partitions; a checkpoint fixes where the range bounds fell, so rerun tasks
    cannot number differently. The only thing gathered is one count per
    partition, from which each partition's offset follows.
    """
    ensure_checkpoints(df.sparkSession)
    ranged = (
        df.select(natural)
        .where(F.col(natural).isNotNull())
        .distinct()
        .repartitionByRange(F.col(natural))
        .sortWithinPartitions(natural)
        .select(natural, F.monotonically_increasing_id().alias("_id"))
        .checkpoint()
        .select(
            natural,
            F.shiftright("_id", _IN_PARTITION).alias("_part"),
            F.col("_id").bitwiseAND((1 << _IN_PARTITION) - 1).alias("_pos"),
        )
    )
    # One number per partition: no more than there are shuffle partitions.
    counts = dict(ranged.groupBy("_part").agg(F.count(F.lit(1))).collect())
    sizes = [counts.get(part, 0) for part in range(max(counts, default=0) + 1)]
    before = [0, *accumulate(sizes)]
    offset = F.element_at(F.lit(before), (F.col("_part") + 1).cast("int"))
    numbered = ranged.select(
        natural, (offset + F.col("_pos") + 1 + base).cast("long").alias(key)
    )
    next_id = df.sparkSession.range(1).select(
        F.lit(base + before[-1] + RESERVE).cast("long").alias("next_id")
    )
    return numbered, next_id


def write_back_key(df: DataFrame, keys: DataFrame, natural: str) -> DataFrame:
    """Give every row of ``df`` the key of its natural value; NULL values get none.

    Rows without a value stay out of the join, where all of them would meet in
    one task.
    """
    (key,) = (c for c in keys.columns if c != natural)
    known = df.where(F.col(natural).isNotNull()).join(keys, natural, "left").select(*df.columns, key)
    none = df.where(F.col(natural).isNull()).withColumn(key, F.lit(None).cast(keys.schema[key].dataType))
    return known.union(none)
