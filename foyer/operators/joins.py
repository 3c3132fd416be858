"""Joins the reports and rules need beyond plain equi-joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import text_key
from .picks import lowest_per_key


def effective_date_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    moment: str,
    start: str = "start_dt",
    end: str = "end_dt",
    how: str = "left",
) -> DataFrame:
    """Match rows of equal keys whose validity holds ``moment``, both ends included.

    The keys come first in the condition, so Spark hashes or merges on them and
    checks the range on the matches. Every valid row matches; the validity
    columns stay out of the result.
    """
    f, d = facts.alias("f"), dim.alias("d")
    cond = F.col(f"f.{moment}").between(F.col(f"d.{start}"), F.col(f"d.{end}"))
    for key in keys:
        cond = (F.col(f"f.{key}") == F.col(f"d.{key}")) & cond
    extra = [c for c in dim.columns if c not in (*keys, start, end)]
    return f.join(d, cond, how).select("f.*", *[F.col(f"d.{c}") for c in extra])


def dependent_left(
    df: DataFrame, detail: DataFrame, keys: Sequence[str], via: str, detail_via: str,
    values: Mapping[str, str],
) -> DataFrame:
    """Left join on ``keys`` and on ``via``, itself the outcome of an earlier left join.

    Rows whose ``via`` is NULL find nothing. ``values`` names the result
    columns by the detail columns they come from.
    """
    right = detail.select(
        *keys,
        F.col(detail_via).alias(via),
        *[F.col(c).alias(name) for c, name in values.items()],
    )
    return df.join(right, [*keys, via], "left")


def not_in_reference(
    df: DataFrame, ref: DataFrame, on: Mapping[str, str], fold: bool = False
) -> DataFrame:
    """Rows with no partner in ``ref``; a NULL key has none, so its row stays.

    With ``fold`` texts are compared without regard to case and trailing blanks.
    """

    def side(column: str) -> Column:
        return text_key(F.col(column)) if fold else F.col(column)

    right = ref.select(*[side(r).alias(f"_{r}") for r in on.values()]).distinct()
    cond = F.lit(True)
    for left, r in on.items():
        cond = cond & (side(left) == F.col(f"_{r}"))
    return df.join(right, cond, "left_anti")


def by_either_key(
    items: DataFrame, targets: DataFrame, scope: Sequence[str], keys: Sequence[str], flag: str
) -> DataFrame:
    """Flag items that match a target by the first of ``keys`` they have.

    A later key counts only for items without the earlier ones. Targets are
    listed under each of their keys, so one equi-join finds all matches.
    """
    listed = F.explode(
        F.array(*[F.struct(F.lit(n).alias("_nth"), F.col(k).alias("_key")) for n, k in enumerate(keys)])
    )
    known = (
        targets.select(*scope, listed.alias("_t"))
        .select(*scope, "_t.*")
        .where(F.col("_key").isNotNull())
        .distinct()
        .withColumn("_hit", F.lit(True))
    )
    nth = F.lit(None).cast("int")
    for n, k in reversed(list(enumerate(keys))):
        nth = F.when(F.col(k).isNotNull(), n).otherwise(nth)
    return (
        items.withColumns({"_nth": nth, "_key": F.coalesce(*[F.col(k) for k in keys])})
        .join(known, [*scope, "_nth", "_key"], "left")
        .select(*items.columns, F.col("_hit").isNotNull().alias(flag))
    )


def rule_lookup(
    df: DataFrame, rules: DataFrame, on: Mapping[str, str], values: Sequence[str]
) -> DataFrame:
    """Left join to a rule table by computed columns; the lowest of several rules counts."""
    keyed = rules.select(*[F.col(r).alias(c) for c, r in on.items()], *values)
    return df.join(lowest_per_key(keyed.dropna(subset=list(on)), list(on), values), list(on), "left")


def with_settings(
    df: DataFrame, settings: DataFrame, wanted: Mapping[str, tuple[Column, str]]
) -> DataFrame:
    """Add single values of a settings table to every row.

    ``wanted`` maps each new column to (which row, which column). Each value is
    a scalar subquery: a missing setting gives NULL, a setting that is there
    twice stops the query. No join takes place.
    """
    return df.withColumns(
        {name: settings.where(row).select(column).scalar() for name, (row, column) in wanted.items()}
    )


def lookup_by_prefix(
    df: DataFrame, matchup: DataFrame, column: str, text: str, value: str, into: str, n: int = 30
) -> DataFrame:
    """Fill ``into``, where it is still NULL, from the row whose text is the column's prefix."""
    right = lowest_per_key(
        matchup.select(text_key(F.col(text)).alias("_prefix"), F.col(value).alias("_value")).dropna(),
        ["_prefix"],
        ["_value"],
    )
    left = df.withColumn("_prefix", text_key(F.left(F.col(column), F.lit(n))))
    filled = F.coalesce(F.col(into), F.col("_value"))
    return left.join(right, "_prefix", "left").select(
        *[filled.alias(c) if c == into else F.col(c) for c in df.columns]
    )
