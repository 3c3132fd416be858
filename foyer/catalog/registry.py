"""Registered queries: a key, a Spark query over the bound tables, its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import tune
from .binding import Binding
from .sql import with_views

Run = Callable[[Binding], DataFrame]


@dataclass(frozen=True)
class Entry:
    key: str
    run: Run
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(
    key: str, sql: str | None = None, views: dict[str, str] | None = None
) -> Callable[[Run], Run]:
    """Register a Spark query; ``sql`` may name the views of ``sql.py`` and of ``views``."""

    def add(run: Run) -> Run:
        if key in ENTRIES:
            raise ValueError(f"query {key} is registered twice")
        ENTRIES[key] = Entry(key, run, None if sql is None else with_views(sql, views))
        return run

    return add


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so both engines print the same number."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def spark_query(entry: Entry) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(entry.run(Binding(tune(spark), folder)))

    run.__name__ = entry.key
    return run
