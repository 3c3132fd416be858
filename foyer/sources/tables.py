"""Parquet and catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A base table stored as Parquet below ``folder``."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def save_table(
    df: DataFrame, name: str, bucket_by: Sequence[str] = (), buckets: int = 0,
    partition_by: Sequence[str] = (),
) -> None:
    """Save as a catalog table, bucketed so later joins on those columns need no shuffle."""
    writer = df.write.mode("errorifexists").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by and buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)


def append_table(df: DataFrame, path: str) -> None:
    """Append rows to a Parquet table."""
    df.write.mode("append").parquet(path)
