"""Loading staging files with rejects, and with checks counted on the way.

One pass reads the file: lines that do not fit the schema become rejects, all
others rows, both are written, and the counts a check asks for are observed while
the lines go by. Nothing reads the file or its rows a second time.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import trimmed_length
from ..session import shared_path

LINE, REJECTED = "_line", "_rejected"


class TooManyErrors(ValueError):
    """More lines were rejected than the load allows; none of its rows count."""


@dataclass(frozen=True)
class Loaded:
    """Rows, rejected lines (column ``line``) and counts (``rule``, ``n_rows``) of a load."""

    rows: DataFrame
    rejects: DataFrame
    counts: DataFrame


def load_staging(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    limits: Mapping[str, int] | None = None,
    required: Mapping[str, Column] | None = None,
    max_errors: int = 10,
    header: bool = True,
) -> Loaded:
    """Load tab-separated files; more than ``max_errors`` rejected lines are an error.

    ``limits`` are lengths that columns should not exceed and ``required`` maps
    rules to conditions that break them; both count accepted rows only. The
    counts ``rows`` and ``rejects`` come first. A line of other fields than the
    schema has, or with a field that is not of its type, is rejected whole.
    """
    lines = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(LINE, T.StringType())]))
        .option("sep", "\t")
        .option("header", header)
        .option("enforceSchema", True)
        .option("quote", "")
        .option("lineSep", "\n")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", LINE)
        .csv(path)
    )
    fine = F.col(LINE).isNull()
    rules = {"rows": fine, "rejects": ~fine}
    rules |= {c: fine & (trimmed_length(F.col(c)) > n) for c, n in (limits or {}).items()}
    rules |= {name: fine & broken for name, broken in (required or {}).items()}
    seen = Observation()
    counted = lines.observe(seen, *[F.count_if(cond).alias(rule) for rule, cond in rules.items()])
    out = shared_path(spark, "loaded")
    counted.withColumn(REJECTED, ~fine).write.partitionBy(REJECTED).parquet(out)
    found = seen.get
    if found["rejects"] > max_errors:
        raise TooManyErrors(f"{found['rejects']} lines were rejected, {max_errors} are allowed")
    kept = T.StructType([*schema.fields, T.StructField(LINE, T.StringType()), T.StructField(REJECTED, T.BooleanType())])
    written = spark.read.schema(kept).parquet(out)
    counts = spark.createDataFrame([(rule, found[rule]) for rule in rules], "rule string, n_rows long")
    return Loaded(
        written.where(~F.col(REJECTED)).select(*schema.names),
        written.where(F.col(REJECTED)).select(F.col(LINE).alias("line")),
        counts,
    )
