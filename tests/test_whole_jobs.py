"""Registered queries do their whole job."""

from __future__ import annotations

import re
import time
from datetime import datetime

from pyspark.sql import functions as F

from foyer import operators as op
from foyer.catalog import ENTRIES, spark_query
from foyer.catalog.binding import Binding
from foyer.catalog.report import SEASONS
from foyer.plans import importer as I
from foyer.plans import many_reports
from foyer.plans import report as R
from foyer.session import names_below, session_folder, stage_scope
from foyer.streaming import event_stream

from conftest import SMALL, rows


def run(spark, key):
    return spark_query(ENTRIES[key])(spark, SMALL)


def test_flag_rollup_ends_in_the_indicators_of_every_customer(spark):
    out = run(spark, "any_flag_rollup")
    assert out.columns == ["customer_no", "create_dt", "emarket_ind", "mail_ind"]
    assert out.count() == spark.read.parquet(f"{SMALL}/customer.parquet").count()


def test_stored_report_has_all_performances_of_the_seasons(spark):
    part = spark.read.parquet(f"{SMALL}/part.parquet")
    want = part.where(part.p_size.isin(*map(int, SEASONS.split(",")))).select("p_partkey")
    assert rows(run(spark, "report_dataset").select("perf_no")) == rows(want)


# --- the same jobs on tables that grow ------------------------------------------


def merged(df):
    return df._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin")


def test_price_maps_of_exploded_tables_are_not_broadcast(spark, small):
    perfs = small["perf"].select("perf_no")
    assert merged(R.price_maps(perfs, small["perf_pmap"], small["subprice"], small["pmap"], [1, 3])) == 2


def test_weekly_rates_are_not_broadcast(spark):
    assert merged(run(spark, "effective_date_join_binned")) == 1


def test_bitmaps_of_scattered_numbers_are_small(spark):
    numbers = [0, 63, 64, 127, 128, 63, 2**31, 2**40 + 63, 2**40]
    df = spark.createDataFrame([(1, n) for n in numbers] + [(1, None), (2, -64), (3, 64)], "k int, n long")
    maps = op.distinct_bitmaps(df, ["k"], "n")
    # One long for each run of 64 numbers, not four kilobytes.
    assert dict(maps.dtypes)["bits"] == "bigint" and maps.count() == 6
    assert rows(op.counted_bitmaps(op.merged_bitmaps(maps, maps), ["k"], "c")) == [(1, 8), (3, 1)]


def test_buyers_are_cleaned_once_and_keyed_alike(spark, small):
    from foyer.catalog.importer import staged, staged_buyers

    once, every = staged_buyers(small), staged(small)
    who = rows(once.select(*I.PERSON))
    assert who == rows(every.select(*I.PERSON).distinct()) and len(who) < every.count()
    more = small["staging"].limit(3)
    assert I.buyers(more.union(more)).count() <= 3


def test_changes_are_streamed_from_as_many_files_as_they_need(spark, monkeypatch):
    from foyer.catalog import cart

    asked = []

    def stream(session, path, schema, files_per_batch):
        asked.append((len(session.read.parquet(path).inputFiles()), files_per_batch))
        return event_stream(session, path, schema, files_per_batch)

    monkeypatch.setattr(cart, "event_stream", stream)
    settings = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        entry = ENTRIES["first_value_audit_stream"]
        out = entry.run(Binding(spark, SMALL))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ((files, batch),) = asked
    assert files > 4 and 2 * batch >= files
    assert rows(out) == rows(ENTRIES["first_value_audit"].run(Binding(spark, SMALL)))


def broadcast(df):
    """The keys and kinds of a plan's broadcast joins."""
    return re.findall(r"BroadcastHashJoin \[(\w+)#.*?\], (\w+), ", df._jdf.queryExecution().executedPlan().toString())


def test_performances_orders_and_details_are_not_broadcast(spark, small):
    chosen = R.select_perfs(small["perf"], small["inventory"], SEASONS)
    maps = [small[name] for name in ("perf_pmap", "subprice", "pmap")]
    net, tax = (R.price_map(chosen, *maps, kind) for kind in (1, 3))
    hist, seats, orders, detail = (small[n] for n in ("order_seat_hist", "perf_seat", "orders", "sli_detail"))
    needed = R.events_needed(hist, chosen, "1996-07-01", "2000-06-30")
    priced = R.priced_history(needed, chosen, orders, seats, net)
    for plan in (
        chosen, net, priced, R.sales_date_range(priced, detail, R.original_payment(priced)),
        R.sales_to_date(seats, chosen, small["sub_lineitem"], orders, net, tax, detail),
        R.hold_totals(small["perf_hold"], small["hold_code"], chosen), R.seat_totals(seats, small["seat"], chosen),
    ):
        # Seat lists and hold codes alone are left to Spark's size check.
        assert {key for key, _ in broadcast(plan)} <= {"seat_no", "hc_no"}


def test_few_listed_performances_may_still_be_broadcast(spark, small):
    listed = R.select_perfs(small["perf"], small["inventory"], SEASONS, "2,40,77")
    many = R.select_perfs(small["perf"], small["inventory"], SEASONS)
    plans = [small["order_seat_hist"].join(p.select("perf_no"), "perf_no", "left_semi") for p in (listed, many)]
    assert [len(broadcast(p)) > 0 for p in plans] == [True, False]


def test_events_are_limited_by_their_seats(spark, small):
    """Performances limit the history though only the seats are joined to them; a listing twice adds nothing."""
    hist, seats, orders = (small[n] for n in ("order_seat_hist", "perf_seat", "orders"))
    net = R.price_map(small["perf"], *[small[n] for n in ("perf_pmap", "subprice", "pmap")], 1)
    some = small["perf"].where("perf_no % 3 = 0")
    got = R.priced_history(hist, some.union(some), orders, seats, net)
    want = R.priced_history(hist.join(some.select("perf_no"), "perf_no", "left_semi"), small["perf"], orders, seats, net)
    assert got.count() == want.count() > 0
    assert got.where("perf_no % 3 <> 0").count() == 0


# --- disk -----------------------------------------------------------------------


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {x for x in files.mkString("\n").split("\n") if "/shuffle_" in x}


def left_after(spark, run):
    """Shuffle files that a job leaves behind; they are removed beside the driver's own thread."""
    before = shuffle_files(spark)
    kept = run()
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    return kept, left


def test_written_stages_leave_no_shuffle_files(spark):
    sums = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n"))
    stage, left = left_after(spark, lambda: op.select_into(sums))
    assert left == set()
    assert rows(stage) == rows(sums)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(setting, "false") == "false"
    # A plan that may run again keeps its files.
    assert sums.collect() and sums.collect()


def sale_tables(small):
    names = ("order_seat_hist", "orders", "perf_seat", "sli_detail", "sub_lineitem")
    chosen = R.select_perfs(small["perf"], small["inventory"], "3,4,5,6,7,8,9")
    maps = [small[name] for name in ("perf_pmap", "subprice", "pmap")]
    return chosen, [R.price_map(chosen, *maps, kind) for kind in (1, 3)], [small[name] for name in names]


def test_steps_of_the_date_range_are_written_one_by_one(spark, small):
    """Same sales as in one plan; no shuffle files stay, and of the stages only the priced events."""
    chosen, (net, _), (hist, orders, seats, detail, _) = sale_tables(small)
    # Seats that are not known, and line items of chosen and of other performances.
    seats = seats.where("seat_no % 4 <> 0")
    hist = hist.withColumn("sli_no", F.expr("CASE WHEN seat_no % 3 > 0 THEN sli_no % 50 END"))
    dates = (datetime(1996, 7, 1), datetime(1997, 6, 30))
    plain = R.priced_history(R.events_needed(hist, chosen, *dates), chosen, orders, seats, net)
    want = rows(R.sales_date_range(plain, detail, R.original_payment(plain), *dates))
    with stage_scope(spark):
        stages = set(names_below(spark, session_folder(spark)))
        priced, left = left_after(spark, lambda: R.written_priced(hist, chosen, orders, seats, net, *dates))
        assert left == set()
        assert len(set(names_below(spark, session_folder(spark))) - stages) == 1
        assert sorted(priced.columns) == sorted(plain.columns)
        assert rows(R.sales_date_range(priced, detail, R.original_payment(priced), *dates)) == want != []


def test_written_sales_to_date_are_those_of_one_plan(spark, small):
    chosen, prices, (_, orders, seats, detail, lines) = sale_tables(small)
    parts = (seats, chosen, lines, orders, *prices, detail)
    with stage_scope(spark):
        stages = set(names_below(spark, session_folder(spark)))
        written, left = left_after(spark, lambda: R.written_to_date(*parts))
        assert left == set()
        assert len(set(names_below(spark, session_folder(spark))) - stages) == 1
        assert rows(written) == rows(R.sales_to_date(*parts)) != []
    # Seats are shuffled by the keys of the prices once for both kinds of prices.
    plan = R.seat_sales(*parts)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"SortMergeJoin \[zone_no", plan)) == 2
    assert len(re.findall(r"hashpartitioning\(zone_no", plan)) == 3


def test_events_of_many_reports_are_written_step_by_step(spark, small):
    """Whole events meet the seats first; shuffle files and stages of earlier steps are gone."""
    tables = {n: small[n] for n in ("order_seat_hist", "orders", "perf_seat")}
    sets = spark.createDataFrame([(1, "3,4,5"), (2, "5,6")], "arg_no int, season_csv string").withColumns(
        {c: F.lit(None).cast("timestamp_ntz") for c in ("perf_start", "perf_end", "sale_start", "sale_end")}
    )
    sets = sets.withColumn("perf_csv", F.lit(None).cast("string"))
    chosen = op.select_into(many_reports.chosen_perfs(small["perf"], small["inventory"], sets))
    perfs = chosen.select("perf_no").distinct().hint("merge")
    net = R.price_map(perfs, *[small[n] for n in ("perf_pmap", "subprice", "pmap")], 1)
    named, _ = many_reports.scopes(chosen)
    with stage_scope(spark):
        pieces, _ = (op.select_into(x) for x in many_reports.pieces_of(sets))
        stages = set(names_below(spark, session_folder(spark)))
        priced, left = left_after(spark, lambda: many_reports.priced_pieces(tables, named, pieces, perfs, net))
        assert left == set()
        assert len(set(names_below(spark, session_folder(spark))) - stages) == 1
        known = R.priced_history(tables["order_seat_hist"], perfs, tables["orders"], tables["perf_seat"], net)
        counted = priced.where("piece IS NOT NULL").select("order_no", "sli_no", "event_code", "nett_pmap", "nett_price")
        both = R.events_in_range(known, None, None).select(*counted.columns)
        assert rows(counted.distinct()) == rows(both.distinct()) != []


def test_one_performance_with_most_seats_is_split_in_both_price_joins(spark):
    seats = spark.range(200_000).select(
        F.when(F.col("id") % 10 > 0, 1).otherwise(F.col("id")).alias("perf_no"), F.lit(2).cast("long").alias("zone_no"),
        F.col("id").alias("seat_no"), F.lit(8).alias("seat_status"), F.col("id").alias("sli_no"), F.col("id").alias("order_no"),
    )
    perfs = spark.range(200_000).select(F.col("id").alias("perf_no")).hint("merge")
    orders = spark.range(200_000).select(F.col("id").alias("order_no"), F.lit("2014-01-10").cast("timestamp_ntz").alias("order_dt"))
    lines = spark.range(200_000).select(F.col("id").alias("sli_no"), F.lit(5).alias("price_type"), F.lit(9).cast("decimal(19,4)").alias("due_amt"))
    start, end = (F.lit(x).cast("timestamp_ntz").alias(n) for x, n in (("2014-01-01", "start_dt"), ("2014-12-31", "end_dt")))
    net, tax = (
        spark.range(200_000).select(
            F.col("id").alias("perf_no"), F.lit(5).alias("price_type"), F.lit(2).cast("long").alias("zone_no"),
            (F.col("id") * 100 + n).alias("pmap_no"), start, end,
        )
        for n in (11, 31)
    )
    detail = lines.select("sli_no", F.lit(111).cast("long").alias("pmap_no"), F.col("due_amt").alias("paid_amt"))
    forced = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    for name, value in forced.items():
        spark.conf.set(name, value)
    try:
        found = R.seat_sales(seats, perfs, lines, orders, net, tax, detail).select("nett", "gst")
        got = found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in forced:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(got) == 200_000 and sum(r["nett"] == 9 for r in got) == 180_000
    # Price type and zone are the same for all rows, so Spark joins by performance alone.
    final = plan.split("Initial Plan")[0]
    assert len(re.findall(r"SortMergeJoin\(skew=true\) \[perf_no#\d+L\], \[perf_no#\d+L\], LeftOuter", final)) == 2
