"""Exact duplicates, combined in three stages so that no group meets in one task.

1. Rows are combined inside each task (the partial aggregate).
2. What is left of a text meets under its digest and a salt, so a text that a
   third of all rows share is merged by many tasks.
3. The winners of the salts are combined into one row for each text.

Every stage groups by the whole text beside its digest. Each row then finds its
group by digest in a join whose large partitions adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.tables import select_into
from .common import free_name, lower_ascii, without

RESULT = ("keep_id", "group_size", "kept", "text_sha256")


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 64) -> DataFrame:
    """``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when they are identical after lowering A-Z. The row with the
    largest id of a group stays. A null text counts as the empty text. A null id
    is smaller than any other; in a group of null ids only, ``keep_id`` is null
    and the rows are kept. Rows that repeat id and text are one document: all of
    them count in ``group_size`` and all bear the same ``kept``. Two texts with
    one digest stop the job rather than being taken for one. Extra columns pass
    through, but for those named like a result column.
    """
    docs = without(docs, RESULT, keep=(id_col, text_col))
    own = F.col(f"`{id_col}`")
    text, salt, keep, size = (free_name(docs, x) for x in ("norm_text", "salt", "keep", "size"))
    plain = docs.select(own.alias(keep), lower_ascii(F.col(f"`{text_col}`")).alias(text))
    salted = (
        plain.select(
            keep, text, F.sha2(text, 256).alias("text_sha256"), (F.spark_partition_id() % salts).alias(salt)
        )
        .groupBy("text_sha256", salt, text)
        .agg(F.max(keep).alias(keep), F.count(F.lit(1)).alias(size))
    )
    texts = salted.groupBy("text_sha256", text).agg(F.max(keep).alias(keep), F.sum(size).alias(size))
    # Written, so that the join below reads both sides from plain shuffles: only then can
    # adaptive execution split the rows of a text that very many documents share.
    groups = select_into(
        texts.groupBy("text_sha256")
        .agg(F.max(keep).alias(keep), F.max(size).alias(size), F.count(F.lit(1)).alias(salt))
        .select(
            "text_sha256",
            F.col(keep),
            F.when(F.col(salt) == 1, F.col(size))
            .otherwise(F.raise_error(F.lit("two texts share one SHA-256 digest")).cast("long"))
            .alias(size),
        )
    )
    keyed = docs.withColumn("text_sha256", F.sha2(lower_ascii(F.col(f"`{text_col}`")), 256))
    return keyed.join(groups, "text_sha256").select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.col(keep).alias("keep_id"),
        F.col(size).alias("group_size"),
        own.eqNullSafe(F.col(keep)).alias("kept"),
        F.col("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`mark_copies` keeps, with their own columns."""
    marked = mark_copies(docs, id_col, text_col)
    return marked.where("kept").select(*[F.col(f"`{c}`") for c in docs.columns if c in marked.columns])
