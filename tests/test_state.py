"""Session state in batch and on streams."""

from __future__ import annotations

import datetime as dt

import pytest

from foyer import streaming as S

from conftest import rows
from foyer.operators import select_into
from foyer.session import names_below, newest_number, remove, session_folder, shared_dir, shared_path, stage_scope
from foyer.sources import StoredTable

SCHEMA = "sessionkey string, name string, value string, ts timestamp_ntz, event_id long"


def events(spark):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    return spark.createDataFrame(
        [
            ("a", "x", "1", at(1), 1), ("a", "x", "2", at(2), 2), ("a", "x", "3", at(2), 3),
            ("a", "y", "1", at(1), 4), ("a", "y", None, at(5), 5),
            ("b", "x", None, at(1), 6), ("b", "x", "9", at(4), 7), ("b", "x", "8", at(0), 8),
        ],
        SCHEMA,
    )


def test_batch_state(spark):
    df = events(spark)
    assert rows(S.state_latest(df)) == [("a", "x", "3"), ("b", "x", "9")]
    assert rows(S.state_changes(df)) == [("a", "x", "3"), ("a", "y", None), ("b", "x", "9")]
    assert rows(S.set_once(df)) == [("a", "x", "1"), ("a", "y", "1"), ("b", "x", "8")]
    assert rows(S.ask_count(df)) == [("a", "Gift_Asked", "2"), ("b", "Gift_Asked", "2")]
    assert rows(S.ask_count(df.where("event_id = 1"))) == [("a", "Gift_Asked", "1")]


def test_apply_changes(spark):
    kind = "sessionkey string, name string, value string"
    old = spark.createDataFrame([("a", "x", "1"), ("a", "y", "2"), ("b", "x", "3")], kind)
    new = spark.createDataFrame([("a", "x", "9"), ("c", "z", "5")], kind)
    gone = spark.createDataFrame([("b", "x", "3")], kind)
    assert rows(S.apply_changes(old, new, gone)) == [("a", "x", "9"), ("a", "y", "2"), ("c", "z", "5")]


STATE = ("sessionkey", "name")
FOLDS = [
    (S.last_rows, S.last_rows, lambda s: s.select("sessionkey", "name", "value"), S.state_changes),
    (S.first_rows, S.first_rows, lambda s: s.select("sessionkey", "name", "value"), S.set_once),
    (S.ask_totals, S.add_totals, S.ask_flag, S.ask_count),
]


@pytest.mark.parametrize(("prepare", "combine", "shown", "batch"), FOLDS)
def test_stream_equals_batch(spark, tmp_path, prepare, combine, shown, batch):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    df = events(spark)
    # One file and so one micro-batch per event; event 8 comes last and is the oldest.
    for n in range(1, 9):
        df.where(f"event_id = {n}").coalesce(1).write.mode("append").parquet(source)
    stream = S.event_stream(spark, source, df.schema, files_per_batch=1)
    table = S.fold_stream(stream, prepare, combine, ["sessionkey"], out, checkpoint)
    assert rows(shown(table.read())) == rows(batch(df))
    assert [p.name for p in (tmp_path / "out" / "_batches").iterdir()] == ["7"]


def test_stream_resumes_from_its_checkpoint(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    df = events(spark)
    for part in ("event_id <= 3", "event_id > 3"):
        df.where(part).write.mode("append").parquet(source)
        table = S.fold_stream(S.event_stream(spark, source, df.schema), S.last_rows, S.last_rows, STATE, out, checkpoint)
    assert rows(table.read()) == rows(S.last_rows(df))


def test_batch_rewrites_its_own_buckets_and_counts_once(spark, tmp_path):
    """A batch that comes again, and one broken off while it is published."""
    path = str(tmp_path / "state")
    asks = lambda *names: spark.createDataFrame([(n, 1) for n in names], "sessionkey string, asks long")
    table = StoredTable(spark, path, asks("a").schema, ("sessionkey",), buckets=512)
    assert table.read().count() == 0
    table.fold(asks(*(f"s{i}" for i in range(200))), S.add_totals, 0)
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "state").rglob("part-*.parquet")}
    before = files()
    changes = table.fold(asks("s7", "new"), S.add_totals, 1)
    left = {p for p, t in files().items() if before.get(p) == t}
    assert len(changes.buckets) == 2 and 0 < len(before) - len(left) <= 2
    assert table.fold(asks("s7", "new"), S.add_totals, 1).buckets == ()
    found = {r.sessionkey: r.asks for r in table.read().collect()}
    assert len(found) == 201 and found["s7"] == 2 and found["new"] == found["s8"] == 1


class Cluster:
    """A session of a cluster without a shared folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_needs_a_shared_folder(spark):
    with pytest.raises(RuntimeError, match="checkpoint"):
        shared_dir(Cluster)


def test_a_scope_removes_the_stages_written_in_it(spark):
    kept = shared_path(spark, "kept", kept=True)
    with stage_scope(spark):
        outer = select_into(spark.range(3))
        with stage_scope(spark):
            inner = select_into(outer.where("id > 0"))
            inner.write.parquet(kept)
        folders = {f.rsplit("/", 1)[0].removeprefix("file:") for f in outer.inputFiles()}
        assert outer.count() == 3
    left = {n for n in names_below(spark, session_folder(spark))}
    assert not any(f.rsplit("/", 1)[1] in left for f in folders) and kept.rsplit("/", 1)[1] in left
    assert spark.read.parquet(kept).count() == 2


def test_stages_are_removed(spark):
    path = shared_path(spark, "gone")
    spark.range(3).write.parquet(path)
    remove(spark, path)
    assert newest_number(spark, path) is None
