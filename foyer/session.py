"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Run-time settings the plans are written for. Everything here can be changed
#: on a live session; cluster sizing (executors, memory, shuffle partitions)
#: stays with whoever submits the job.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join input even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Where none is set, a local master uses a folder of its own below
    ``spark.local.dir``; on a cluster that is an error, as executors would not
    see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = f"{spark.conf.get('spark.local.dir', '/tmp')}/foyer-{spark.sparkContext.applicationId}"
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def session_folder(spark: SparkSession) -> str:
    """The folder below the shared one that is this application's own."""
    return f"{shared_dir(spark).rstrip('/')}/foyer/{spark.sparkContext.applicationId}"


#: Whether a job's shuffle files are removed when it ends, or only when the driver next collects its garbage.
_REMOVED_AT_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside leave no shuffle files behind.

    For jobs whose plan nothing runs again, as the writing of a stage: what comes
    later reads the written files. A session without that setting keeps the files.
    """
    before = spark.conf.get(_REMOVED_AT_END, None)
    spark.conf.set(_REMOVED_AT_END, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVED_AT_END)
        else:
            spark.conf.set(_REMOVED_AT_END, before)


#: Paths handed out inside each open scope.
_SCOPES: list[list[str]] = []


def shared_path(spark: SparkSession, name: str, kept: bool = False) -> str:
    """A fresh path below the shared folder, under the application that writes it.

    It belongs to the innermost open :func:`stage_scope`, unless it is ``kept``.
    """
    path = f"{session_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _SCOPES and not kept:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, every stage that was written inside.

    Build, read and write a result inside the scope: DataFrames that read one of
    its stages can't be read any more after it.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            remove(spark, path)


def _place(spark: SparkSession, path: str):
    """A path and the store it is in."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    target, store = _place(spark, path)
    store.delete(target, True)


def names_below(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies in a folder; none where there is no folder."""
    target, store = _place(spark, path)
    return [x.getPath().getName() for x in store.listStatus(target)] if store.exists(target) else []


def make_folder(spark: SparkSession, path: str) -> None:
    target, store = _place(spark, path)
    store.mkdirs(target)


def newest_number(spark: SparkSession, path: str) -> int | None:
    """The highest number that names a folder below ``path``."""
    return max((int(n) for n in names_below(spark, path) if n.isdigit()), default=None)


def drop_stages(spark: SparkSession) -> None:
    """Delete all stages this application has written; their DataFrames can't be read any more."""
    remove(spark, session_folder(spark))


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable in this session."""
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
