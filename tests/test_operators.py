"""Operators on small fixtures, skewed inputs included."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from foyer import operators as op
from foyer.operators import intervals
from foyer.schemas import SCHEMAS
from foyer.sources import read_staging, save_table, write_staging

from conftest import has_types, rows


def test_surrogate_key(spark):
    df = spark.createDataFrame([(30,), (10,), (20,), (None,), (10,)], "legacy_no long")
    keys, next_id = op.surrogate_key(df, "legacy_no", "customer_no")
    assert rows(keys) == [(10, 100001), (20, 100002), (30, 100003)]
    assert rows(next_id) == [(100013,)]
    back = op.write_back_key(df, keys, "legacy_no")
    assert rows(back) == [(None, None), (10, 100001), (10, 100001), (20, 100002), (30, 100003)]


def test_surrogate_key_dense_over_partitions(spark):
    df = spark.range(0, 50_000, 1, 16).select((F.col("id") * 7 % 49_999).cast("string").alias("k"))
    keys, _ = op.surrogate_key(df, "k", "n", base=0)
    got = keys.orderBy("k").collect()
    assert [r["n"] for r in got] == list(range(1, len(got) + 1))
    assert len(got) == df.distinct().count()


def test_surrogate_key_of_nothing(spark):
    empty = spark.createDataFrame([], "k long")
    keys, next_id = op.surrogate_key(empty, "k", "n")
    assert rows(keys) == [] and rows(next_id) == [(100010,)]


def skewed(spark, n=30_000):
    """A third of the rows have key 0, a third none, the rest are spread."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.col("id") % 997)
    return spark.range(0, n, 1, 8).select(key.alias("k"), "id")


def test_binned_join_gives_the_rows_of_the_plain_one(spark):
    day = "timestamp_ntz'2020-01-01'"
    facts = spark.range(400).selectExpr("id AS i", "id % 5 AS k", f"{day} + make_dt_interval(cast(id * 7 % 800 as int), cast(id % 24 as int)) AS at")
    facts = facts.union(spark.createDataFrame([(1000, 1, None), (1001, None, None)], facts.schema))
    dim = spark.range(300).selectExpr(
        "id % 6 AS k", f"{day} + make_dt_interval(cast(id * 11 % 900 as int) - 100) AS start_dt", "cast(id % 40 as int) AS long", "id AS v"
    ).selectExpr("k", "start_dt", "start_dt + make_dt_interval(long) AS end_dt", "v")
    at = lambda text: dt.datetime.fromisoformat(text)
    odd = [(1, at("0001-01-01"), at("9999-12-31"), 900), (1, at("2021-01-01"), at("2020-01-01"), 901), (2, None, at("2022-01-01"), 902), (2, at("2020-01-01"), None, 903), (None, at("2020-01-01"), at("2022-01-01"), 904)]
    dim = dim.union(spark.createDataFrame(odd, dim.schema))
    for how in ("left", "inner"):
        plain = op.effective_date_join(facts, dim, ["k"], "at", how=how)
        for days in (1, 31):
            assert rows(op.binned_date_join(facts, dim, ["k"], "at", how=how, days=days)) == rows(plain)
    assert op.binned_date_join(facts.limit(0), dim, ["k"], "at").count() == 0
    assert op.binned_date_join(facts, dim.limit(0), ["k"], "at").count() == 402


def test_rows_that_meet_the_date_test_grow_with_matches(spark):
    """Ten times the versions, each a tenth as long: the plain join tests ten times the pairs, the binned one as many."""
    facts = spark.range(1000).selectExpr("id % 3 AS k", "timestamp_ntz'2020-01-01' + make_dt_interval(cast(id as int)) AS at")

    def tested(days, versions):
        dim = spark.range(versions).selectExpr("explode(array(0, 1, 2)) AS k", "timestamp_ntz'2020-01-01' + make_dt_interval(cast(id as int) * %d) AS start_dt" % days)
        dim = dim.selectExpr("cast(k as long) AS k", "start_dt", "start_dt + make_dt_interval(%d) - INTERVAL '0.000001' SECOND AS end_dt" % days)
        left, right = intervals.binned(facts, dim, "at", "start_dt", "end_dt", days)
        assert op.binned_date_join(facts, dim, ["k"], "at", how="inner", days=days).count() == 1000
        return left.join(right, ["k", "_bin"]).count()

    assert max(tested(100, 10), tested(10, 100)) <= 2000


def test_elementary_pieces(spark):
    at = lambda d, us=0: dt.datetime(2024, 1, d) + dt.timedelta(microseconds=us)
    rules = [("a", at(1), at(10), 5), ("a", at(4), at(6), 3), ("a", at(6), at(8), 9), ("a", at(20), at(19), 1), ("b", at(2), None, 1), (None, at(1), at(2), 7)]
    df = spark.createDataFrame(rules, "k string, start_dt timestamp_ntz, end_dt timestamp_ntz, v int")
    found = [tuple(r) for r in op.elementary_pieces(df, ["k"], ["v"], "start_dt", "end_dt", 3).where("k = 'a'").orderBy("start_dt").collect()]
    assert [(s, e) for _, s, e, _ in found] == [(at(1), at(4, -1)), (at(4), at(6, -1)), (at(6), at(6)), (at(6, 1), at(8)), (at(8, 1), at(10))]
    assert [v for *_, v in found] == [5, 3, 3, 5, 5]


def test_effective_date_join_keeps_every_match(spark):
    day = lambda d: dt.datetime(2014, 1, d)
    facts = spark.createDataFrame([(1, 5, day(10)), (2, 5, day(20)), (3, 6, day(10))], "i int, k int, at timestamp_ntz")
    dim = spark.createDataFrame(
        [(5, day(1), day(10), "a"), (5, day(10), day(15), "b"), (6, day(11), day(12), "c")],
        "k int, start_dt timestamp_ntz, end_dt timestamp_ntz, v string",
    )
    out = op.effective_date_join(facts, dim, ["k"], "at").select("i", "v")
    assert rows(out) == [(1, "a"), (1, "b"), (2, None), (3, None)]


def test_dependent_left_needs_the_first_match(spark):
    df = spark.createDataFrame([(1, 7), (2, None), (3, 8)], "sli int, pm int")
    detail = spark.createDataFrame([(1, 7, 10), (2, 7, 20), (3, 7, 30)], "sli int, no int, paid int")
    out = op.dependent_left(df, detail, ["sli"], "pm", "no", {"paid": "p"})
    assert rows(out.select("sli", "p")) == [(1, 10), (2, None), (3, None)]


def test_updates_and_deletes(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    source = spark.createDataFrame([(1, "z"), (1, "y"), (None, "n")], "k int, w string")
    out = op.update_from(df, source, ["k"], {"v": F.col("src_w")})
    assert rows(out) == [(None, "c"), (1, "y"), (2, "b")]
    only = op.update_from(df, source, ["k"], {"v": F.col("src_w")}, where=F.col("v") == "x")
    assert rows(only) == rows(df)
    assert rows(op.update_where(df, F.col("k") > 1, {"v": F.lit("u")})) == [(None, "c"), (1, "a"), (2, "u")]
    assert rows(op.delete_where(df, F.col("k") == 1)) == [(None, "c"), (2, "b")]


def test_append_and_conform(spark):
    target = spark.createDataFrame([], SCHEMAS["const_cust"])
    out = op.append_rows(target, spark.createDataFrame([(5,)], "customer_no int"), constituency=3)
    assert has_types(out, SCHEMAS["const_cust"]) and rows(out) == [(3, 5)]


def test_select_into(spark):
    df = spark.range(5).withColumn("m", F.lit(1).cast("decimal(19,4)"))
    assert rows(op.select_into(df)) == rows(df)


def test_reference_checks(spark):
    df = spark.createDataFrame([("NSW", "AU"), ("nsw ", "NZ"), ("XX", "AU"), (None, "AU")], "s string, c string")
    states = spark.createDataFrame([("NSW", 1), ("AKL", 2)], "id string, country int")
    countries = spark.createDataFrame([(1, "AU"), (2, "NZ")], "id int, description string")
    assert rows(op.invalid_reference(df, "s", states, "id")) == [("XX",)]
    assert rows(op.invalid_reference(df, "s", states, "id", keep_null=True)) == [(None,), ("XX",)]
    assert rows(op.invalid_pairs(df, "s", "c", states, countries, "au")) == [(None, "AU"), ("XX", "AU")]


def test_counting_checks(spark):
    df = spark.createDataFrame([("abc", ""), ("abcd   ", "x"), (None, None)], "a string, b string")
    counts = op.length_overflow(df, {"a": 3, "b": 0})
    assert rows(counts) == [("a", 1), ("b", 1)]
    blank = op.missing_required(df, {"b": F.coalesce("b", F.lit("")) == ""})
    assert rows(blank) == [("b", 2)]
    want = spark.createDataFrame([("a", 1), ("b", 9), ("gone", 4)], "rule string, n_rows long")
    checked = op.reconcile_counts(counts.where("rule = 'a'").unionByName(blank), want)
    assert rows(checked) == [("a", 1, 1, True), ("b", 9, 2, False), ("gone", 4, None, False)]
    extra = op.reconcile_counts(blank, want.limit(0))
    assert rows(extra) == [("b", None, 2, False)]


def test_first_per_key_keeps_the_first(spark):
    history = spark.createDataFrame([("s", 1, 50)], "sessionkey string, sli_no int, orig int")
    changes = spark.createDataFrame(
        [("s", 1, 60, 1), ("s", 2, 70, 2), ("s", 2, 80, 1), ("t", 1, 90, 3)],
        "sessionkey string, sli_no int, orig int, at int",
    )
    out = op.first_per_key(history, changes, ["sessionkey", "sli_no"], ["at"])
    assert rows(out) == [("s", 1, 50), ("s", 2, 80), ("t", 1, 90)]


def test_fallback_pick(spark):
    items = spark.createDataFrame([(1, 10), (2, 10), (3, None)], "season int, prod int")
    content = spark.createDataFrame(
        [(1, 9, "s9"), (2, 8, "s8"), (10, 9, "p9b"), (10, 9, "p9a"), (1, 17, None)],
        "inv_no int, content_type int, value string",
    )
    picks = {"image": [("season", 9), ("prod", 9), ("season", 8)]}
    out = op.fallback_pick(items, content, picks)
    assert rows(out.select("season", "image")) == [(1, "s9"), (2, "p9a"), (3, "")]


def test_with_settings_refuses_two_rows(spark):
    settings = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "kind string, v int")
    one = spark.range(2)
    out = op.with_settings(one, settings, {"a": (F.col("kind") == "a", "v"), "z": (F.col("kind") == "z", "v")})
    assert rows(out) == [(0, 1, None), (1, 1, None)]
    with pytest.raises(Exception, match="SCALAR_SUBQUERY"):
        op.with_settings(one, settings, {"b": (F.col("kind") == "b", "v")}).collect()


def test_staging_file(spark, tmp_path):
    text = "legacy_no\tname\tamount\n1\t\"Ann\" O'Neil\t12.5\n2\t\t\n"
    path = tmp_path / "in.txt"
    path.write_text(text)
    from foyer.schemas import LONG, MONEY, TEXT, table

    schema = table(legacy_no=LONG, name=TEXT, amount=MONEY)
    got = read_staging(spark, str(path), schema).collect()
    assert [tuple(map(str, r)) for r in got] == [("1", "\"Ann\" O'Neil", "12.5000"), ("2", "None", "None")]
    (tmp_path / "bad.txt").write_text(text + "x\ty\tz\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        read_staging(spark, str(tmp_path / "bad.txt"), schema).collect()
    out = str(tmp_path / "out")
    write_staging(read_staging(spark, str(path), schema), out)
    assert rows(read_staging(spark, out, schema)) == rows(read_staging(spark, str(path), schema))


def test_bucketed_tables_join_without_shuffle(spark):
    spark.sql("DROP TABLE IF EXISTS t_left")
    spark.sql("DROP TABLE IF EXISTS t_right")
    df = spark.range(1000).withColumn("v", F.col("id") * 2)
    for name in ("t_left", "t_right"):
        save_table(df, name, bucket_by=["id"], buckets=4)
    joined = spark.table("t_left").hint("merge").join(spark.table("t_right"), "id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    for name in ("t_left", "t_right"):
        spark.sql(f"DROP TABLE {name}")


def test_overlapping_validity(spark):
    ranges = [
        ("apart", 1, 2), ("apart", 3, 4),
        ("touch", 1, 2), ("touch", 2, 3),
        ("inside", 1, 9), ("inside", 3, 4),
        ("same", 1, 1), ("same", 1, 1),
        ("late", 1, 2), ("late", 5, 8), ("late", 6, 7),
        ("wrong", 5, 1), ("wrong", 2, 3),
    ]
    at = lambda n: dt.datetime(2014, 1, 1 + n // 3, n % 3 * 8)
    spans = [(k, at(a), at(z)) for k, a, z in ranges]
    df = spark.createDataFrame(spans, "k string, start_dt timestamp_ntz, end_dt timestamp_ntz")
    assert rows(op.overlapping_validity(df, ["k"])) == [("inside",), ("late",), ("same",), ("touch",)]


def test_adaptive_execution_splits_a_hot_key(spark):
    """The key write-back leaves a hot natural value to adaptive execution."""
    staged = skewed(spark, 300_000).withColumn("text", F.sha2(F.col("id").cast("string"), 512))
    keys = spark.range(0, 997).select(F.col("id").alias("k"), (F.col("id") + 100).alias("n"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    }
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        out = op.write_back_key(staged, keys, "k").groupBy("n").agg(F.count("text").alias("c"))
        got = dict(out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in small:
            spark.conf.unset(name)
    assert "skew=true" in plan
    assert got[100] >= 100_000 and sum(got.values()) == 300_000
