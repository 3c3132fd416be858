"""The sales report on hand-checked cases."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from foyer.catalog.binding import REPORT_TABLES
from foyer.plans import report as R
from foyer.plans.history import PricedHistory
from foyer.plans.many_reports import promoter_sales_many
from foyer.schemas import SCHEMAS

from conftest import has_types, rows

D = Decimal
AT = dt.datetime(2014, 1, 10)
EARLY, LATE = dt.datetime(2014, 1, 1), dt.datetime(2014, 12, 31)


def frame(spark, columns, *data):
    return spark.createDataFrame(list(data), columns)


@pytest.fixture
def tables(spark):
    """Performance 1 with four seats; a net and a tax price map; one history."""
    price = "pmap_no long, zmap_no int, zone_no long, price decimal(19,4)"
    return {
        "perf": frame(
            spark, "perf_no long, perf_code string, perf_dt timestamp_ntz, prod_season_no long, season int",
            (1, "P1", AT, 100, 8), (2, "P2", EARLY, 100, 8), (3, "P3", AT, 100, 80),
        ),
        "inventory": frame(spark, "inv_no long, description string", (1, "One"), (2, "Two"), (3, "Three")),
        "perf_pmap": frame(
            spark,
            "perf_no long, pmap_no long, price_category int, price_type int, start_dt timestamp_ntz, end_dt timestamp_ntz",
            (1, 11, 1, 5, EARLY, LATE), (1, 31, 3, 5, EARLY, LATE),
        ),
        "subprice": frame(spark, price, (11, 1, 2, D(90)), (31, 1, 2, D(9)), (11, 2, 2, D(1))),
        "pmap": frame(spark, "pmap_no long, zmap_no int, desig_code int", (11, 1, 1), (31, 1, 1), (11, 2, 7)),
        "orders": frame(spark, "order_no long, order_dt timestamp_ntz", (7, AT), (8, AT)),
        "perf_seat": frame(
            spark,
            "perf_no long, seat_no long, zone_no long, seat_status int, sli_no long, order_no long, logical_seat_num long",
            (1, 1, 2, 13, 71, 7, 1), (1, 2, 2, 8, 72, 7, 2), (1, 3, 2, 7, 73, 7, 3), (1, 4, 2, 8, 81, 8, 4),
            (1, 5, 2, 0, None, None, 5), (1, 6, 2, 6, None, None, 6), (1, 7, 2, 3, None, None, None),
            (1, 8, 2, None, None, None, 8), (1, 9, 2, 0, None, None, 9),
        ),
        "sub_lineitem": frame(
            spark, "sli_no long, price_type int, due_amt decimal(19,4)",
            (71, 5, D(50)), (72, 5, D(50)), (73, 5, D(50)), (81, 5, D(0)),
        ),
        "sli_detail": frame(
            spark, "sli_no long, pmap_no long, paid_amt decimal(19,4)",
            (71, 11, D(90)), (71, 31, D(9)), (72, 11, D(90)), (72, 31, D(9)),
        ),
        "order_seat_hist": frame(
            spark,
            "order_no long, sli_no long, perf_no long, price_type int, seat_no long, event_code int, "
            "event_date timestamp_ntz, amount decimal(19,4), sli_paid_amt decimal(19,4)",
            (7, 71, 1, 5, 1, 26, AT, D(100), D(88)),
            (7, 72, 1, 5, 2, 26, AT, D(101), D(88)),
            (7, 73, 1, 5, 3, 1, AT, D(0), D(0)),
            (8, 81, 1, 5, 4, 26, LATE, D(100), D(88)),
        ),
        "seat": frame(
            spark, "seat_no long, seat_type int",
            (1, 1), (2, 1), (3, 1), (4, 8), (5, 1), (6, 1), (7, 1), (8, 1), (9, None),
        ),
        "perf_hold": frame(spark, "perf_no long, hc_no long", (1, 1), (1, 5), (1, 2), (1, 5)),
        "hold_code": frame(spark, "hc_no long, type int", (1, 1), (2, 2), (5, 5)),
    }


def args(**more):
    given = {"season_csv": "8,9", "as_of": LATE, "sale_start": EARLY, "sale_end": dt.datetime(2014, 1, 31)}
    return R.ReportArgs(**{**given, **more})


def test_whole_report(tables):
    out = R.promoter_sales(tables, args())
    assert has_types(out, SCHEMAS["report"])
    first, second = out.collect()
    assert (first["perf_no"], second["perf_no"]) == (2, 1)
    got = second.asDict()
    assert got == {
        "perf_no": 1, "perf_code": "P1", "perf_dt": AT, "perf_desc": "One",
        "DR_tix_count": 2, "DR_tix_value": D(90), "TD_tix_count": 2, "TD_tix_value": D(180),
        "TD_GST_value": D(18), "TD_comp_count": 1, "TD_consig_count": 2, "TD_unpaid_count": 1,
        "TD_holds": 1, "TD_available": 1, "TD_capacity": 4, "sales_snapshot_dt": dt.datetime(2014, 1, 31),
    }


def test_equal_net_totals_collapse_or_add(tables):
    whole = R.promoter_sales(tables, args(), collapse_equal_nett=False).where("perf_no = 1").first()
    assert (whole["DR_tix_count"], whole["DR_tix_value"]) == (2, D(180))


def test_report_totals(tables):
    *lines, total = R.with_totals(R.promoter_sales(tables, args())).collect()
    assert [r["is_total"] for r in lines] == [0, 0] and total["is_total"] == 1
    assert total["perf_no"] is None and total["perf_desc"] is None
    assert (total["TD_tix_count"], total["TD_tix_value"], total["TD_capacity"]) == (2, D(180), 4)


def test_empty_selection(tables):
    out = R.promoter_sales(tables, args(perf_csv="0"))
    assert has_types(out, SCHEMAS["report"]) and out.count() == 0


def selected(tables, *more):
    return [r[0] for r in rows(R.select_perfs(tables["perf"], tables["inventory"], *more).select("perf_no"))]


def test_performance_selection(tables):
    assert selected(tables, "8") == [1, 2]
    assert selected(tables, "8,80") == [1, 2, 3]
    assert selected(tables, "8", None, dt.datetime(2014, 1, 5)) == [1]
    assert selected(tables, "8", "1,3", dt.datetime(2014, 6, 1)) == [1]
    assert selected(tables, "8", "0") == []


def test_sales_to_date_total_is_price_times_sold(small):
    b = small
    perfs = R.select_perfs(b["perf"], b["inventory"], ",".join(map(str, range(1, 51))))
    maps = [b["perf_pmap"], b["subprice"], b["pmap"]]
    nett, gst = (R.price_map(perfs, *maps, n) for n in (1, 3))
    parts = (b["perf_seat"], perfs, b["sub_lineitem"], b["orders"], nett, gst, b["sli_detail"])
    seats = R.seat_sales(*parts)
    grouped = R.sales_to_date(*parts)
    want = seats.agg(F.sum(F.col("nett") * F.col("sold")), F.sum(F.col("gst") * F.col("sold"))).first()
    got = grouped.agg(F.sum("nett"), F.sum("gst")).first()
    assert want[0] > 0 and tuple(got) == tuple(want)


def test_original_payment_of_a_line_item_with_two_orders(spark):
    """Item 71 was paid in order 7 and given back in order 8."""
    at = dt.datetime
    schema = (
        "order_no long, sli_no long, perf_no long, price_type int, zone_no long, seat_no long, event_code int, "
        "event_date timestamp_ntz, amount decimal(19,4), sli_paid_amt decimal(19,4), nett_pmap long, nett_price decimal(19,4)"
    )
    rows_ = [
        (7, 71, 1, 1, 1, 5, 26, at(2014, 1, 1), 90, 90, 11, 90),
        (7, 71, 1, 1, 1, 5, 26, at(2014, 1, 2), 90, 80, 11, 80),
        (8, 71, 1, 1, 1, 5, 27, at(2014, 2, 1), 90, 90, 11, 90),
    ]
    priced = spark.createDataFrame([tuple(Decimal(v) if i in (8, 9, 11) else v for i, v in enumerate(r)) for r in rows_], schema)
    detail = spark.createDataFrame([], "sli_no long, pmap_no long, paid_amt decimal(19,4)")
    original = R.original_payment(priced)

    def total(**how):
        sales = R.sales_date_range(priced, detail, original, at(2014, 1, 15), at(2014, 3, 1), **how)
        return tuple(sales.agg(F.sum("no_seats_sold"), F.sum("nett")).first())

    assert total() == (-3, Decimal(-260))
    assert total(original_by=R.BY_ORDER) == (-1, Decimal(-90))


def test_plans_are_built_without_jobs(spark, small):
    b = small
    chosen = R.select_perfs(b["perf"], b["inventory"], "3,17")
    maps = [b["perf_pmap"], b["subprice"], b["pmap"]]
    # Reading a file's schema is a job of its own; operators see tables that are open.
    b.tables(*REPORT_TABLES)
    spark.sparkContext.setJobGroup("building", "plans")
    nett, gst = (R.price_map(chosen, *maps, n) for n in (1, 3))
    R.sales_to_date(b["perf_seat"], chosen, b["sub_lineitem"], b["orders"], nett, gst, b["sli_detail"])
    needed = R.events_needed(b["order_seat_hist"], chosen, None, None)
    priced = R.priced_history(needed, chosen, b["orders"], b["perf_seat"], nett)
    R.sales_date_range(priced, b["sli_detail"], R.original_payment(priced))
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_signed_events(spark):
    events = [(26, 5), (27, 5), (3, 5), (4, 0), (4, 5), (1, 0), (1, 5), (25, 5), (26, None)]
    df = spark.createDataFrame(events, "c int, a int")
    out = df.select(R.signed_count(F.col("c"), F.col("a")).alias("n")).collect()
    assert [r["n"] for r in out] == [1, -1, -1, -1, None, 1, None, None, 1]


def test_pick_lists(tables, spark):
    season = spark.createDataFrame([(1, "B", 2013), (2, "A", 2014), (3, "A", 2013)], "id int, description string, fyear int")
    assert [r["id"] for r in R.season_pick_list(season).collect()] == [2, 3, 1]
    labels = [r["label"] for r in R.perf_pick_list(tables["perf"], "8").collect()]
    assert labels == ["Jan  1 2014 12:00AM P2", "Jan 10 2014 12:00AM P1"]


def test_list_arguments_and_columns_reach_the_scan(small):
    chosen = R.select_perfs(small["perf"], small["inventory"], "3,17", "2,40")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "In(p_size, [17,3])" in plan or "In(p_size, [3,17])" in plan
    assert "In(p_partkey, [2,40])" in plan or "In(p_partkey, [40,2])" in plan
    held = R.hold_totals(small["perf_hold"], small["hold_code"], chosen)
    read = held._jdf.queryExecution().executedPlan().toString()
    assert "l_partkey:bigint,l_suppkey:bigint,l_returnflag:string>" in read.replace(" ", "")


def test_history_stored_day_by_day_gives_the_report_of_the_whole(spark, tables, tmp_path):
    hist = tables["order_seat_hist"]
    nett = R.of_category(R.price_maps(tables["perf"], tables["perf_pmap"], tables["subprice"], tables["pmap"], [1]), 1)
    args = (tables["perf"], tables["orders"], tables["perf_seat"], nett)
    store = PricedHistory(spark, str(tmp_path / "history"), 4)
    days = sorted(r[0] for r in hist.select(F.col("event_date").cast("date")).distinct().collect())
    assert len(days) > 1
    for load, day in enumerate(days):
        store.add(hist.where(F.col("event_date").cast("date") == F.lit(day)), load, *args)
    perfs = R.select_perfs(tables["perf"], tables["inventory"], "8")
    priced = R.priced_history(hist, perfs, *args[1:])
    whole = R.original_payment(priced)
    assert rows(store.original_payment(perfs)) == rows(whole)
    for start, end in ((None, None), (days[0], days[0]), (days[-1], None)):
        found = store.sales_date_range(perfs, tables["sli_detail"], start, end)
        assert rows(found) == rows(R.sales_date_range(priced, tables["sli_detail"], whole, start, end))
    # A load that runs again changes nothing, and a range reads the loads of its days only.
    store.add(hist.where(F.col("event_date").cast("date") == F.lit(days[0])), 0, *args)
    assert rows(store.original_payment(perfs)) == rows(whole)
    part = store.events(days[0], dt.datetime.combine(days[0], dt.time(23, 59)))
    scan = next(x for x in part._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x)
    assert "PartitionFilters: [isnotnull(load" in scan and "GreaterThanOrEqual(event_day" in scan
    assert part.where("load <> 0").count() == 0 < part.count()
    assert store.events(dt.datetime(1990, 1, 1), dt.datetime(1990, 1, 2)).count() == 0


@pytest.mark.parametrize("collapse", [True, False])
def test_many_argument_sets_equal_their_single_runs(spark, tables, collapse):
    """Fifty sets in one job: dates in steps, seasons and lists, with line items whose events are in several performances."""
    more = tables["order_seat_hist"].where("order_no = 7")
    moved = more.withColumn("perf_no", F.lit(3).cast("long"))
    seats = tables["perf_seat"].union(tables["perf_seat"].withColumn("perf_no", F.lit(3).cast("long")))
    maps = tables["perf_pmap"].union(tables["perf_pmap"].withColumn("perf_no", F.lit(3).cast("long")))
    tables = tables | {"order_seat_hist": tables["order_seat_hist"].union(moved), "perf_seat": seats, "perf_pmap": maps}
    days = [None, *sorted(r[0] for r in tables["order_seat_hist"].select("event_date").distinct().collect())]
    csv = ["8", "8,80", "80", "1,2,3"]
    sets = [
        (n, csv[n % 4], [None, None, "1,3", "0", "3"][n % 5], days[n % len(days)], days[-1 - n % 3], AT + dt.timedelta(n))
        for n in range(50)
    ]
    schema = "arg_no int, season_csv string, perf_csv string, sale_start timestamp_ntz, sale_end timestamp_ntz, as_of timestamp_ntz"
    args = spark.createDataFrame(sets, schema).withColumns(
        {c: F.lit(None).cast("timestamp_ntz") for c in ("perf_start", "perf_end")}
    )
    found = {}
    for r in promoter_sales_many(tables, args, collapse).collect():
        found.setdefault(r.arg_no, []).append(tuple(r)[1:])
    seen = 0
    for n, seasons, listed, start, end, as_of in (sets[i] for i in ((0, 6, 17, 22, 41) if collapse else (0, 6, 10, 17, 22, 29, 41))):
        single = R.promoter_sales(tables, R.ReportArgs(seasons, as_of, listed, None, None, start, end), collapse)
        want = rows(single)
        seen += len(want)
        assert sorted(found.get(n, []), key=str) == sorted(want, key=str), n
    assert seen > 3


def test_ambiguous_prices(spark):
    day = lambda n: dt.datetime(2020, 1, n)
    maps = [
        (1, 11, 1, 1, day(1), day(10)), (1, 12, 1, 1, day(10), day(20)),  # both hold on the tenth
        (2, 21, 1, 1, day(1), day(9)), (2, 22, 1, 1, day(10), day(20)),  # one after the other
        (3, 31, 1, 1, day(1), day(9)), (3, 32, 3, 1, day(1), day(9)),  # of two categories
        (4, 41, 1, 1, day(1), day(9)),  # one map with two prices
        (5, 51, 1, 1, day(1), day(9)), (5, 51, 1, 1, day(1), day(9)),  # a row that is there twice
        (6, 61, 1, 1, day(1), day(9)), (6, 62, 1, 1, day(5), day(6)),  # the second for no seats
        (7, 71, 1, 1, day(1), day(9)), (7, 72, 1, 2, day(1), day(9)),  # of two price types
        (8, 81, 1, 1, day(1), day(9)), (8, 82, 1, 1, day(9), day(1)),  # the second never holds
        (9, 91, 9, 1, day(1), day(9)), (9, 92, 9, 1, day(1), day(9)),  # of a category not asked for
    ]
    perf_pmap = spark.createDataFrame(
        maps, "perf_no long, pmap_no long, price_category int, price_type int, start_dt timestamp_ntz, end_dt timestamp_ntz"
    )
    numbers = sorted({m[1] for m in maps})
    subprice = [(n, 1, 0, Decimal(n)) for n in numbers] + [(41, 1, 0, Decimal(7)), (41, 1, 5, Decimal(7)), (11, 1, 3, Decimal(1))]
    subprice = spark.createDataFrame(subprice, "pmap_no long, zmap_no int, zone_no long, price decimal(19,4)")
    pmap = spark.createDataFrame([(n, 1, 2 if n == 62 else 1) for n in numbers], "pmap_no long, zmap_no int, desig_code int")
    perfs = spark.range(1, 10).select(F.col("id").alias("perf_no"))
    prices = R.price_maps(perfs, perf_pmap, subprice, pmap, (1, 3))
    assert rows(R.ambiguous_prices(prices)) == [(1, 1, 1, 0), (1, 4, 1, 0)]
    assert rows(R.ambiguous_prices(prices.limit(0))) == []
