"""Row-set statements: append, materialise, update, delete."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_path, shuffles_removed
from .picks import lowest_per_key


def conform(df: DataFrame, schema: T.StructType, **constants) -> DataFrame:
    """``df`` with exactly the target's columns and types.

    A target column comes from ``df``, else from ``constants``, else is NULL.
    """
    have = set(df.columns)
    out = []
    for field in schema.fields:
        if field.name in have:
            value = F.col(field.name)
        else:
            given = constants.get(field.name)
            value = given if isinstance(given, Column) else F.lit(given)
        out.append(value.cast(field.dataType).alias(field.name))
    return df.select(*out)


def append_rows(target: DataFrame, rows: DataFrame, **constants) -> DataFrame:
    """``target`` followed by ``rows`` brought to its columns."""
    return target.unionByName(conform(rows, target.schema, **constants))


def select_into(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a stage as a table in the shared folder and read it back.

    Later stages start from the written files, so a lost executor costs no
    recomputation of what came before, and the shuffle files of what came before
    are removed at once.
    """
    spark = df.sparkSession
    path = path or shared_path(spark, "stage")
    with shuffles_removed(spark):
        df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def update_from(
    df: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    assign: Mapping[str, Column],
    where: Column | None = None,
) -> DataFrame:
    """Update columns of ``df`` from the matching row of ``source``.

    ``assign`` maps columns of ``df`` to expressions over its own columns and
    the source's, the latter under the prefix ``src_``. Where the source has
    several rows for a key the lowest one counts, so ``df`` keeps its rows.
    Rows without a match, or outside ``where``, stay as they are.
    """
    on = list(on)
    values = [c for c in source.columns if c not in on]
    one = lowest_per_key(source.dropna(subset=on), on, values)
    one = one.select(*on, *[F.col(c).alias(f"src_{c}") for c in values], F.lit(True).alias("src_"))
    hit = F.col("src_").isNotNull()
    if where is not None:
        hit = hit & where
    changed = {c: F.when(hit, e).otherwise(F.col(c)) for c, e in assign.items()}
    joined = df.join(one, on, "left")
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in df.columns])


def update_where(df: DataFrame, cond: Column, assign: Mapping[str, Column]) -> DataFrame:
    """Update columns where ``cond`` is true; unknown counts as not true."""
    return df.withColumns({c: F.when(cond, e).otherwise(F.col(c)) for c, e in assign.items()})


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """Delete rows where ``cond`` is true; unknown keeps the row."""
    return df.where(~F.coalesce(cond, F.lit(False)))
