"""Tab-separated staging files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_staging(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True
) -> DataFrame:
    """Read typed columns by position; the first line is skipped.

    Fields are never quoted, an empty field is NULL, and one bad row fails the
    load. The files are split by Spark, so their size does not matter.
    """
    return (
        spark.read.schema(schema)
        .option("sep", "\t")
        .option("header", header)
        .option("enforceSchema", True)
        .option("quote", "")
        .option("lineSep", "\n")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_staging(df: DataFrame, path: str) -> None:
    """Write rows in the layout :func:`read_staging` reads."""
    (
        df.write.option("sep", "\t")
        .option("header", True)
        .option("quote", "")
        .option("escape", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("lineSep", "\n")
        .csv(path)
    )
