"""The corpus pipeline: toxic documents go, copies and near copies go, sources are mixed, texts become tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foyer.llm import bpe, exact, mixing, neardup, toxicity
from foyer.llm.common import prepare, table
from foyer.llm.queries import PATTERN, RANKS, TARGETS
from foyer.operators.tables import select_into

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on all labelled ones, does not reject."""
    prepare(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.classify(docs, model).where(F.col("predicted") == 0).select(*COLUMNS)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    prepare(spark)
    return exact.drop_copies(docs).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest id."""
    prepare(spark)
    return neardup.drop_near_copies(docs).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources have their target shares, in random order."""
    prepare(spark)
    return mixing.replicate(docs, TARGETS).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's token ids, and the number of bytes they decode to."""
    prepare(spark)
    coded = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN)
    size = F.size("token_ids").cast("long").alias("n_tokens")
    return coded.select("doc_id", "source", "token_ids", size, F.octet_length("decoded").alias("n_bytes"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("mix_sources", mix),
    ("byte_bpe", tokens),
]

#: The classifier and the tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is written to the shared folder and read back as the next one's documents."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES:
        docs = select_into(stage(spark, docs, sf_dir))
    return docs
