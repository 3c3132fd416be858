"""Stored tables that are changed where they lie.

A stored table is a folder of Parquet files partitioned by a bucket of its keys. A
change reads the buckets of the keys it names and rewrites those in which a row
really changes; all other files stay. The new rows are first written in full
beside the table, then published by Spark's dynamic partition overwrite. A run
that breaks off before the new rows are complete has changed nothing; one that
breaks off later is taken up by the next, which publishes the same rows again.
One job at a time may change a table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.picks import lowest_per_key
from ..operators.tables import select_into
from ..session import make_folder, names_below, newest_number, remove

BUCKET = "bucket"


@dataclass(frozen=True)
class Changes:
    """What a change did: rows by kind, and the buckets it rewrote."""

    updated: int = 0
    deleted: int = 0
    inserted: int = 0
    buckets: tuple[int, ...] = ()


@dataclass(frozen=True)
class StoredTable:
    """A table at ``path`` with the columns of ``schema``, in ``buckets`` buckets of ``keys``."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int = 64

    def read(self) -> DataFrame:
        """The rows; none before the first write."""
        return self._rows().drop(BUCKET)

    def create(self, rows: DataFrame) -> StoredTable:
        """Write the table for the first time."""
        self._write(self._typed(rows), self.path, "errorifexists")
        return self

    def merge(
        self,
        source: DataFrame,
        assign: Mapping[str, Column] | None = None,
        where: Column | None = None,
        delete: Column | None = None,
        insert: bool = False,
    ) -> Changes:
        """Update, delete and insert by the rows of ``source`` with equal keys.

        Where a row finds its keys in the source and ``where`` holds, it is
        deleted if ``delete`` holds, else the columns of ``assign`` take their
        values. Expressions see the row's own columns and the source's under the
        prefix ``src_``. Where the source has several rows for a key the lowest
        one counts. With ``insert`` keys that the table does not have are added
        from the source's columns of the same names, others NULL. NULL keys find
        nothing and are not added. Unknown conditions count as false.
        """
        self.recover()
        self._free(assign or {})
        keys = list(self.keys)
        values = [c for c in source.columns if c not in keys]
        own = source.select(*[F.col(k).cast(self.schema[k].dataType) for k in keys], *values)
        one = lowest_per_key(own.dropna(subset=keys), keys, values)
        one = select_into(one.select(*keys, *[F.col(c).alias(f"src_{c}") for c in values], F.lit(True).alias("src_")))
        touched = one.select(self._bucket().alias(BUCKET)).distinct()
        # At most one row for each bucket comes to the driver.
        old = self._rows([r[BUCKET] for r in touched.collect()]).withColumn("own_", F.lit(True))
        both = old.drop(BUCKET).join(one, keys, "full" if insert else "left")
        hit = F.col("own_").isNotNull() & F.col("src_").isNotNull() & _sure(F.lit(True) if where is None else where)
        gone = hit & _sure(F.lit(False) if delete is None else delete)
        new = F.col("own_").isNull()
        after = {}
        for name in self.schema.names:
            value = F.col(name)
            if assign and name in assign:
                value = F.when(hit & ~gone, assign[name].cast(self.schema[name].dataType)).otherwise(value)
            if insert and name in values:
                value = F.when(new, F.col(f"src_{name}").cast(self.schema[name].dataType)).otherwise(value)
            after[name] = value
        return self._changed(both, after, gone, new)

    def update(self, cond: Column, assign: Mapping[str, Column]) -> Changes:
        """Update columns where ``cond`` holds."""
        self.recover()
        self._free(assign)
        hit, rows = _sure(cond), self._rows()
        kind = {c: self.schema[c].dataType for c in assign}
        after = {c: F.when(hit, assign[c].cast(kind[c])).otherwise(F.col(c)) if c in assign else F.col(c) for c in self.schema.names}
        return self._changed(rows, after, F.lit(False), F.lit(False))

    def delete(self, cond: Column) -> Changes:
        """Delete rows where ``cond`` holds."""
        self.recover()
        after = {c: F.col(c) for c in self.schema.names}
        return self._changed(self._rows(), after, _sure(cond), F.lit(False))

    def fold(self, rows: DataFrame, combine: Callable[[DataFrame], DataFrame], batch: int) -> Changes:
        """Reduce the rows of the touched buckets together with ``rows``; batch numbers never fall.

        A batch whose number is not above the last published one is passed over.
        """
        self.recover()
        last = newest_number(self.spark, self._batches)
        if last is not None and batch <= last:
            return Changes()
        rows = select_into(self._typed(rows))
        # At most one row for each bucket comes to the driver.
        touched = [r[BUCKET] for r in rows.select(BUCKET).distinct().collect()]
        if touched:
            both = rows.drop(BUCKET).unionByName(self._rows(touched).drop(BUCKET))
            self._publish(self._typed(combine(both)), touched, batch)
        return Changes(buckets=tuple(sorted(touched)))

    def recover(self) -> None:
        """Finish a change that was broken off after its rows were complete, and drop one broken off before."""
        if "_SUCCESS" not in names_below(self.spark, f"{self._pending}/buckets"):
            remove(self.spark, self._pending)
            return
        told = self.spark.read.schema(f"{BUCKET} int, batch long").parquet(f"{self._pending}/buckets").collect()
        full = {n.partition("=")[2] for n in names_below(self.spark, f"{self._pending}/rows") if "=" in n}
        if full:
            schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
            self._write(self.spark.read.schema(schema).parquet(f"{self._pending}/rows"), self.path, "overwrite")
        for row in told:
            if str(row[BUCKET]) not in full:
                remove(self.spark, f"{self.path}/{BUCKET}={row[BUCKET]}")
        batch = max((r["batch"] for r in told if r["batch"] is not None), default=None)
        if batch is not None:
            before = newest_number(self.spark, self._batches)
            make_folder(self.spark, f"{self._batches}/{batch}")
            if before is not None and before != batch:
                remove(self.spark, f"{self._batches}/{before}")
        remove(self.spark, self._pending)

    @property
    def _pending(self) -> str:
        return f"{self.path}/_pending"

    @property
    def _batches(self) -> str:
        return f"{self.path}/_batches"

    def _free(self, assign: Mapping[str, Column]) -> None:
        if set(assign) & set(self.keys):
            raise ValueError("keys of a stored table can't be assigned")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _typed(self, rows: DataFrame) -> DataFrame:
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        return typed.withColumn(BUCKET, self._bucket())

    def _rows(self, buckets: Sequence[int] | None = None) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        if not any(n.startswith(f"{BUCKET}=") for n in names_below(self.spark, self.path)):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(self.path)
        return rows if buckets is None else rows.where(F.col(BUCKET).isin(list(buckets)))

    def _write(self, rows: DataFrame, path: str, mode: str) -> None:
        # Spark cuts a bucket that is too large into several files, and packs small ones into one task.
        writer = rows.hint("rebalance", F.col(BUCKET)).write.mode(mode).partitionBy(BUCKET)
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)

    def _changed(self, rows: DataFrame, after: Mapping[str, Column], gone: Column, new: Column) -> Changes:
        """Publish the buckets in which a row is new, gone or different."""
        moved = F.lit(False)
        for name, value in after.items():
            moved = moved | ~value.eqNullSafe(F.col(name))
        marked = rows.select(
            *[v.alias(n) for n, v in after.items()], gone.alias("gone_"), new.alias("new_"),
            (moved & ~gone & ~new).alias("moved_"),
            (F.col(BUCKET) if BUCKET in rows.columns else self._bucket()).alias(BUCKET),
        )
        kinds = [F.count_if(c).alias(c) for c in ("moved_", "gone_", "new_")]
        # At most one row for each bucket comes to the driver.
        found = marked.where("moved_ or gone_ or new_").groupBy(BUCKET).agg(*kinds).collect()
        touched = sorted(r[BUCKET] for r in found)
        if touched:
            kept = marked.where(F.col(BUCKET).isin(touched) & ~F.col("gone_"))
            self._publish(kept.select(*self.schema.names, BUCKET), touched)
        totals = [sum(r[k] for r in found) for k in ("moved_", "gone_", "new_")]
        return Changes(*totals, tuple(touched))

    def _publish(self, rows: DataFrame, buckets: Sequence[int], batch: int | None = None) -> None:
        """Write the rows of ``buckets`` beside the table, then their list, and only then replace them."""
        self._write(rows, f"{self._pending}/rows", "overwrite")
        told = self.spark.createDataFrame([(b, batch) for b in buckets], f"{BUCKET} int, batch long")
        told.coalesce(1).write.mode("overwrite").parquet(f"{self._pending}/buckets")
        self.recover()


def _sure(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))
