"""Reductions of session events to state.

Each is a grouped aggregate, combined on the map side before the shuffle, so a
session may hold any share of the events. ``last_rows``, ``first_rows`` and
``add_totals`` reduce their own results again: with them a stream folds each
micro-batch into a snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import codes

KEYS = ("sessionkey", "name")
ORDER = ("ts", "event_id")


def last_rows(
    events: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER, value: str = "value"
) -> DataFrame:
    """Latest value per key with its place in the order; NULL where the key was deleted last."""
    last = F.max_by(F.struct(value, *order), F.struct(*order))
    return events.groupBy(*keys).agg(last.alias("_row")).select(*keys, "_row.*")


def first_rows(
    events: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER, value: str = "value"
) -> DataFrame:
    """First value per key with its place in the order."""
    first = F.min_by(F.struct(value, *order), F.struct(*order))
    known = events.where(F.col(value).isNotNull()).groupBy(*keys)
    return known.agg(first.alias("_row")).select(*keys, "_row.*")


def state_changes(
    events: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER, value: str = "value"
) -> DataFrame:
    """Latest value per key; NULL where the key was deleted last."""
    return last_rows(events, keys, order, value).select(*keys, value)


def state_latest(
    events: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER, value: str = "value"
) -> DataFrame:
    """Latest value per key; an event without value deletes the key."""
    return state_changes(events, keys, order, value).where(F.col(value).isNotNull())


def set_once(
    events: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER, value: str = "value"
) -> DataFrame:
    """First value per key; later ones change nothing."""
    return first_rows(events, keys, order, value).select(*keys, value)


def ask_totals(asks: DataFrame) -> DataFrame:
    """How often each session was asked."""
    return asks.groupBy("sessionkey").agg(F.count(F.lit(1)).alias("asks"))


def add_totals(totals: DataFrame) -> DataFrame:
    return totals.groupBy("sessionkey").agg(F.sum("asks").alias("asks"))


def ask_flag(totals: DataFrame, cap: int = 2) -> DataFrame:
    """The count as the variable stores it: ``1``, then ``2`` for good."""
    return totals.select(
        "sessionkey",
        F.lit(codes.VAR_GIFT_ASKED).alias("name"),
        F.least(F.col("asks"), F.lit(cap)).cast("string").alias("value"),
    )


def ask_count(asks: DataFrame, cap: int = 2) -> DataFrame:
    return ask_flag(ask_totals(asks), cap)


def apply_changes(
    state: DataFrame, upserts: DataFrame, deletes: DataFrame, keys: Sequence[str] = KEYS
) -> DataFrame:
    """State after deletes and upserts, one row per key on each side."""
    keys = list(keys)
    gone = upserts.select(*keys).unionByName(deletes.select(*keys)).distinct()
    return state.join(gone, keys, "left_anti").unionByName(upserts.select(*state.columns))
