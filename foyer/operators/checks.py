"""Data checks: they return the offending rows or counts and stop nothing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import same_text
from ..functions.text import trimmed_length
from .joins import not_in_reference


def invalid_reference(
    df: DataFrame,
    column: str,
    ref: DataFrame,
    ref_column: str,
    show: Sequence[str] = (),
    keep_null: bool = False,
) -> DataFrame:
    """Distinct values that the reference list does not hold."""
    wanted = list(dict.fromkeys([*show, column]))
    values = df.select(*wanted).distinct()
    if not keep_null:
        values = values.where(F.col(column).isNotNull())
    return not_in_reference(values, ref, {column: ref_column}, fold=True)


def invalid_pairs(
    df: DataFrame,
    state: str,
    country: str,
    states: DataFrame,
    countries: DataFrame,
    only: str,
    show: Sequence[str] = (),
) -> DataFrame:
    """Distinct rows of one country whose state does not belong to it.

    ``states`` has (id, country), ``countries`` has (id, description).
    """
    valid = states.select(F.col("id").alias("state_id"), F.col("country").alias("country_id")).join(
        countries.select(F.col("id").alias("country_id"), F.col("description").alias("country_name")),
        "country_id",
    )
    wanted = list(dict.fromkeys([*show, state, country]))
    rows = df.where(same_text(F.col(country), F.lit(only))).select(*wanted).distinct()
    return not_in_reference(rows, valid, {state: "state_id", country: "country_name"}, fold=True)


def length_overflow(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows over each length limit, counted for all columns in one pass."""
    counts = df.agg(
        *[F.count_if(trimmed_length(F.col(c)) > n).alias(c) for c, n in limits.items()]
    )
    return _as_rules(counts, list(limits))


def missing_required(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each rule, counted for all rules in one pass."""
    counts = df.agg(*[F.count_if(broken).alias(rule) for rule, broken in rules.items()])
    return _as_rules(counts, list(rules))


def _as_rules(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    return counts.unpivot([], [F.col(n) for n in names], "rule", "n_rows")


def reconcile_counts(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Compare ``(rule, n_rows)`` with expected counts of the same form.

    A rule that only one side has is shown with NULL for the other, and is not ok.
    """
    want = expected.select("rule", F.col("n_rows").cast("long").alias("expected"))
    have = actual.select("rule", F.col("n_rows").cast("long").alias("actual"))
    both = want.join(have, "rule", "full")
    return both.select("rule", "expected", "actual", F.expr("expected <=> actual").alias("ok"))


def profile_distinct(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def profile_many(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, n_rows)`` for the different values of each column, as text; one scan and one shuffle for all.

    Grouping sets of one column each: rows are combined before the shuffle, so a
    value may be that of any share of the rows.
    """
    sets = df.groupingSets([[c] for c in columns], *columns)
    counts = sets.agg(F.count(F.lit(1)).alias("n_rows"), *[(F.grouping(c) == 0).alias(f"_{c}") for c in columns])
    column, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for c in columns:
        column = F.when(F.col(f"_{c}"), F.lit(c)).otherwise(column)
        value = F.when(F.col(f"_{c}"), F.col(c).cast("string")).otherwise(value)
    return counts.select(column.alias("column"), value.alias("value"), "n_rows")


def invalid_values(df: DataFrame, refs: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``(column, value, n_rows)``: values of each column that its reference list does not hold.

    Values are compared without regard to case and trailing blanks, NULL is not
    checked. All columns are profiled in one pass and meet all lists in one join.
    """
    lists = None
    for column, (ref, name) in refs.items():
        own = ref.select(F.lit(column).alias("column"), F.col(name).cast("string").alias("known"))
        lists = own if lists is None else lists.unionByName(own)
    found = profile_many(df, list(refs)).where(F.col("value").isNotNull())
    return not_in_reference(found, lists, {"column": "column", "value": "known"}, fold=True)


def overlapping_validity(
    dim: DataFrame, keys: Sequence[str], start: str = "start_dt", end: str = "end_dt"
) -> DataFrame:
    """Keys with two validity ranges that share a moment, both ends included.

    Starts and ends are counted per key and moment, then summed up in two
    steps: over the days of a key, of which the calendar has only so many, and
    over the different moments of one of its days. No pairs of ranges are formed;
    the largest group is the moments of one key and day, each counted once.
    """
    step = F.explode(
        F.array(
            F.struct(F.col(start).alias("at"), F.lit(1).alias("opens"), F.lit(0).alias("closes")),
            F.struct(F.col(end).alias("at"), F.lit(0).alias("opens"), F.lit(1).alias("closes")),
        )
    ).alias("_step")
    by_day = [*keys, "_day"]
    moments = (
        dim.where(F.col(start) <= F.col(end))
        .select(*keys, step)
        .groupBy(*keys, F.to_date("_step.at").alias("_day"), F.col("_step.at").alias("_at"))
        .agg(F.sum("_step.opens").alias("_opens"), F.sum("_step.closes").alias("_closes"))
        .withColumn("_net", F.col("_opens") - F.col("_closes"))
    )

    def before(group: Sequence[str], order: str) -> Column:
        rows = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_net").over(rows), F.lit(0))

    days = moments.groupBy(*by_day).agg(F.sum("_net").alias("_net"))
    carried = days.select(*by_day, before(keys, "_day").alias("_carried"))
    inside = moments.withColumn("_earlier", before(by_day, "_at"))
    opened = F.col("_carried") + F.col("_earlier") + F.col("_opens")
    return (
        inside.join(carried, by_day)
        .where((opened > 1) & (F.col("_opens") > 0))
        .select(*keys)
        .distinct()
    )
