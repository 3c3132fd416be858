"""Stored tables: changes rewrite the buckets they touch and survive being broken off."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from foyer.operators import delete_where, update_from, update_where
from foyer.sources import Changes, StoredTable

class BrokenOff(Exception):
    """What stops a change in the middle."""


SCHEMA = "id long, name string, amount double"


def data(spark, n=1000):
    return spark.range(n).selectExpr("id", "concat('n', id % 7) AS name", "double(id) AS amount")


def make(spark, tmp_path, df, buckets=128):
    return StoredTable(spark, str(tmp_path / "t"), df.schema, ("id",), buckets).create(df)


def files(tmp_path):
    return {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("part-*.parquet")}


def test_update_of_few_keys_rewrites_their_buckets(spark, tmp_path):
    df = data(spark)
    table = make(spark, tmp_path, df)
    before = files(tmp_path)
    source = df.where("id % 100 = 3").select("id", F.lit("changed").alias("name"))
    assign = {"name": F.concat("src_name", F.lit("!"))}
    done = table.merge(source, assign)
    assert (done.updated, done.deleted, done.inserted) == (10, 0, 0) and len(done.buckets) <= 10
    kept = {p for p, t in files(tmp_path).items() if before.get(p) == t}
    assert len(before) - len(kept) <= 10 and len(kept) >= 118
    assert rows(table.read()) == rows(update_from(df, source, ["id"], assign))
    after = files(tmp_path)
    assert table.merge(source, assign) == Changes() and files(tmp_path) == after


def test_merge_updates_deletes_and_inserts(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, None, None), (3, "c", 3.0), (None, "n", 0.0)], SCHEMA)
    table = make(spark, tmp_path, df, 4)
    source = spark.createDataFrame(
        [(1, 9.0, "x"), (1, 8.0, "y"), (2, None, None), (3, -1.0, "gone"), (7, 7.0, "new"), (None, 5.0, "z")],
        "id int, amount double, kind string",
    )
    done = table.merge(source, {"amount": F.col("src_amount")}, delete=F.col("src_kind") == "gone", insert=True)
    assert (done.updated, done.deleted, done.inserted) == (2, 1, 1)
    assert rows(table.read()) == rows(
        spark.createDataFrame([(1, "a", 8.0), (1, "b", 8.0), (2, None, None), (7, None, 7.0), (None, "n", 0.0)], SCHEMA)
    )
    with pytest.raises(ValueError, match="keys"):
        table.merge(source, {"id": F.lit(1)})


def test_update_and_delete_where(spark, tmp_path):
    df = data(spark, 100)
    table = make(spark, tmp_path, df, 16)
    few = F.col("id").isin(5, 6)
    done = table.update(few, {"amount": F.lit(-1)})
    assert done.updated == 2 and len(done.buckets) <= 2 and table.update(few, {"amount": F.lit(-1)}) == Changes()
    whole = update_where(df, few, {"amount": F.lit(-1.0)})
    assert rows(table.read()) == rows(whole)
    assert table.delete(F.col("amount") < 0).deleted == 2
    assert table.delete(F.lit(None).cast("boolean")) == Changes()
    assert rows(table.read()) == rows(delete_where(whole, F.col("amount") < 0))
    assert table.delete(F.lit(True)).deleted == 98 and table.read().count() == 0
    assert table.merge(df.limit(3), insert=True).inserted == 3


@pytest.mark.parametrize("step", ["rows", "list", "publish"])
def test_change_broken_off(spark, tmp_path, monkeypatch, step):
    """Before its rows are complete nothing has changed; after that the next run publishes them."""
    df = data(spark, 50)
    table = make(spark, tmp_path, df, 8)
    write = StoredTable._write

    def stopping(self, got, path, mode):
        if step == "publish" or (step == "list" and path != self.path):
            write(self, got, path, mode)
        if step == "rows" or path == self.path:
            raise BrokenOff

    late = update_where(df, F.col("id") < 5, {"name": F.lit("late")})
    with monkeypatch.context() as patch, pytest.raises(BrokenOff):
        patch.setattr(StoredTable, "_write", stopping)
        table.update(F.col("id") < 5, {"name": F.lit("late")})
    assert rows(table.read()) == rows(late if step == "publish" else df)
    table.recover()
    assert rows(table.read()) == rows(df if step == "rows" else late)
    table.update(F.col("id") < 5, {"name": F.lit("late")})
    assert rows(table.read()) == rows(late) and not (tmp_path / "t" / "_pending").exists()
