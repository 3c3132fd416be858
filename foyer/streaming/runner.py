"""Fold a stream of event files into a stored state."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import shared_path
from ..sources.stored import StoredTable

Step = Callable[[DataFrame], DataFrame]


def event_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Stream the Parquet files at ``path``."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def fold_stream(
    events: DataFrame,
    prepare: Step,
    combine: Step,
    keys: Sequence[str],
    out: str | None = None,
    checkpoint: str | None = None,
    buckets: int = 64,
) -> StoredTable:
    """Drain the stream into a table of the state, one row for each of ``keys``.

    Each micro-batch is reduced by ``prepare`` like a batch of its own. The
    table is kept in buckets of its keys; the rows of the buckets that the batch
    touches are reduced together with the batch's by ``combine`` and written
    anew, all other buckets stay as they are. So a batch costs what its keys'
    buckets hold, not what the state holds; give so many buckets that a batch
    touches few. Spark keeps no state between batches, so none can grow without
    bound, and events may come as late as they like. A batch that runs again
    after it was published changes nothing, one broken off is taken up.
    """
    spark = events.sparkSession
    table = StoredTable(spark, out or shared_path(spark, "stream"), prepare(events).schema, tuple(keys), buckets)
    query = (
        events.writeStream.foreachBatch(lambda batch, number: table.fold(prepare(batch), combine, number))
        .option("checkpointLocation", checkpoint or shared_path(spark, "stream-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return table
