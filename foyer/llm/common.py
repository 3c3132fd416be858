"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tune

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rows of one Arrow batch. Texts can be long, so batches hold few of them.
BATCH_ROWS = 256


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators are written for.

    Python workers find this package where the driver has it, whatever folder they start in.
    """
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    places, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    known = [p for p in places.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        places["PYTHONPATH"] = os.pathsep.join([root, *known])
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(df: DataFrame, names: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """``df`` without extra columns that bear the name of a result column."""
    keep = {c.lower() for c in keep}
    drop = {n.lower() for n in names} - keep
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in drop])


def lower_ascii(text: Column) -> Column:
    """``text`` with only A-Z lowered; null becomes empty."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def fold(key: Column, folds: int) -> Column:
    """The fold of a row: crc32 of its key as text, modulo ``folds``."""
    return F.crc32(key.cast("string").cast("binary")) % folds
