"""One row or value out of several, as aggregates that combine before the shuffle.

None of them sorts a key's rows in one task, so a key may hold any share of the
table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _spread_struct(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    return df.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in values])


def lowest_per_key(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The lowest row, by ``values`` in order, of each key."""
    if not values:
        return df.select(*keys).distinct()
    best = df.groupBy(*keys).agg(F.min(F.struct(*values)).alias("_row"))
    return _spread_struct(best, keys, values)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The last row of each key by ``order``."""
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_row"))
    return _spread_struct(best, keys, values)


def earliest_per_key(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The first row of each key by ``order``."""
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*values), F.struct(*order)).alias("_row"))
    return _spread_struct(best, keys, values)


def first_per_key(
    history: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """``history`` plus the first change of every key it does not hold yet."""
    keys = list(keys)
    values = [c for c in history.columns if c not in keys]
    first = earliest_per_key(changes, keys, values, order)
    new = first.join(history.select(*keys).distinct(), keys, "left_anti")
    return history.unionByName(new.select(*history.columns))


def fallback_pick(
    items: DataFrame,
    content: DataFrame,
    picks: Mapping[str, Sequence[tuple[str, int]]],
    key: str = "inv_no",
    kind: str = "content_type",
    value: str = "value",
    default: str | None = "",
) -> DataFrame:
    """Add columns filled from the first lookup that has a value.

    ``picks`` maps each new column to its lookups in order, a lookup being
    (column of ``items`` that holds the key, content type). The content table
    is turned once into one row per key with a column per type, and joined once
    per key column. Of several values for a key and type the lowest counts.
    """
    wanted: dict[str, list[int]] = {}
    for lookups in picks.values():
        for column, number in lookups:
            numbers = wanted.setdefault(column, [])
            if number not in numbers:
                numbers.append(number)
    out = items
    for column, numbers in wanted.items():
        by_type = (
            content.where(F.col(kind).isin(*numbers) & F.col(value).isNotNull())
            .groupBy(F.col(key).alias(column))
            .agg(
                *[
                    F.min(F.when(F.col(kind) == n, F.col(value))).alias(f"_{column}_{n}")
                    for n in numbers
                ]
            )
        )
        out = out.join(by_type, column, "left")
    chosen = [
        F.coalesce(*[F.col(f"_{column}_{n}") for column, n in lookups], F.lit(default)).alias(name)
        for name, lookups in picks.items()
    ]
    return out.select(*items.columns, *chosen)
