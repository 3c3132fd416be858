"""Promoter sales report: sales in a date range and to date, per performance.

``tables`` maps names to DataFrames: perf, inventory, perf_pmap, subprice, pmap,
orders, order_seat_hist, perf_seat, sub_lineitem, sli_detail, seat, perf_hold,
hold_code.

The fact tables (seats, seat history, line items, orders) are joined on their
own keys. Performances and price maps grow with the venue list, and files of
their ascending numbers are far smaller than the rows in memory, so Spark's size
check would broadcast millions of them. Their joins and those of fact tables are
merged; only performances listed by number, which are few, are left to Spark.
One performance may hold a large share of the seats and of the history. No two
joins on performance keys follow each other, so each reads plain shuffles, of
which adaptive execution splits the skewed ones. Every sum is combined before
its shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import codes
from ..functions import between_open, in_csv, short_datetime, snapshot_dt
from ..functions.dates import Moment
from ..operators import (
    conform,
    dependent_left,
    effective_date_join,
    overlapping_validity,
    select_into,
)
from ..schemas import SCHEMAS
from ..session import shared_path, stage_scope

MEASURES = (
    "DR_tix_count", "DR_tix_value", "TD_tix_count", "TD_tix_value", "TD_GST_value",
    "TD_comp_count", "TD_consig_count", "TD_unpaid_count", "TD_holds", "TD_available",
    "TD_capacity",
)


@dataclass(frozen=True)
class ReportArgs:
    """Arguments of the report. Without a performance list the performance dates count."""

    season_csv: str
    as_of: Moment
    perf_csv: str | None = None
    perf_start: Moment | None = None
    perf_end: Moment | None = None
    sale_start: Moment | None = None
    sale_end: Moment | None = None


# --- performances -----------------------------------------------------------


def select_perfs(
    perf: DataFrame,
    inventory: DataFrame,
    season_csv: str,
    perf_csv: str | None = None,
    start: Moment | None = None,
    end: Moment | None = None,
) -> DataFrame:
    """Performances of the seasons: those listed, or those in the date range.

    With a list the dates do not count; the list ``"0"`` selects nothing.
    Without one there may be many, so they are merged with what they are joined to.
    """
    chosen = in_csv(F.col("season"), season_csv)
    if perf_csv is None:
        chosen = chosen & between_open(F.col("perf_dt"), start, end)
    elif perf_csv == "0":
        chosen = F.lit(False)
    else:
        chosen = chosen & in_csv(F.col("perf_no"), perf_csv)
    described = inventory.select(F.col("inv_no").alias("perf_no"), F.col("description").alias("perf_desc"))
    found = (
        perf.where(chosen)
        .join(described.hint("merge"), "perf_no")
        .select("perf_no", "perf_dt", "perf_code", "perf_desc", "prod_season_no")
    )
    return found.hint("merge") if perf_csv is None else found


def season_pick_list(season: DataFrame) -> DataFrame:
    """Seasons, newest fiscal year first."""
    return season.select("id", "description", "fyear").orderBy(
        F.desc("fyear"), "description", "id"
    )


def perf_pick_list(perf: DataFrame, season_csv: str) -> DataFrame:
    """Performances of the seasons with their label, by date."""
    return (
        perf.where(in_csv(F.col("season"), season_csv))
        .select(
            "perf_no",
            F.concat(short_datetime(F.col("perf_dt")), F.lit(" "), F.col("perf_code")).alias("label"),
            "perf_dt",
        )
        .orderBy("perf_dt", "perf_no")
    )


# --- prices -----------------------------------------------------------------


def price_maps(
    perfs: DataFrame, perf_pmap: DataFrame, subprice: DataFrame, pmap: DataFrame,
    categories: Sequence[int],
) -> DataFrame:
    """Prices per category, performance, price type, zone and validity.

    Each performance has many rows in these tables, which may be exploded from few: Spark's size
    check then takes them for small. The joins are merged, so none of them is broadcast.
    """
    seat_maps = pmap.where(F.col("desig_code") == codes.DESIGNATION_SEAT).select("pmap_no", "zmap_no")
    zoned = subprice.join(seat_maps.hint("merge"), ["pmap_no", "zmap_no"])
    return (
        perf_pmap.where(F.col("price_category").isin(*categories))
        .join(perfs.select("perf_no"), "perf_no", "left_semi")
        .join(zoned.hint("merge"), "pmap_no")
        .select(
            "price_category", "perf_no", "price_type", "zone_no", "price", "pmap_no", "start_dt",
            "end_dt",
        )
        .distinct()
    )


def of_category(prices: DataFrame, category: int) -> DataFrame:
    return prices.where(F.col("price_category") == category).drop("price_category")


def price_map(
    perfs: DataFrame, perf_pmap: DataFrame, subprice: DataFrame, pmap: DataFrame, category: int
) -> DataFrame:
    """Prices of one category."""
    return of_category(price_maps(perfs, perf_pmap, subprice, pmap, [category]), category)


PRICE_KEYS = ("perf_no", "price_type", "zone_no")


def ambiguous_prices(prices: DataFrame) -> DataFrame:
    """Where a report would count a seat more than once: category and keys with several prices valid at one moment.

    ``prices`` are those of ``price_maps``, so maps of another designation and equal rows do not
    count. Two prices of one map are ambiguous as well as those of two maps.
    """
    return overlapping_validity(prices, ["price_category", *PRICE_KEYS])


def _priced(rows: DataFrame, prices: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Left join to the prices valid at ``order_dt``; ``names`` renames the price columns wanted."""
    wanted = prices.select(
        *PRICE_KEYS, "start_dt", "end_dt", *[F.col(c).alias(n) for c, n in names.items()]
    )
    return effective_date_join(rows, wanted.hint("merge"), list(PRICE_KEYS), "order_dt")


# --- sales to date ----------------------------------------------------------


def seat_flags(df: DataFrame) -> DataFrame:
    """Sold, reserved and complimentary seats as 0/1 columns."""
    due = F.coalesce(F.col("due_amt"), F.lit(0))
    paid = F.col("seat_status").isin(*codes.SEAT_PAID)

    def flag(cond: Column) -> Column:
        return F.when(cond, 1).otherwise(0)

    return df.withColumns(
        {
            "sold": flag((due > 0) & paid),
            "reserved": flag(F.col("seat_status") == codes.SEAT_RESERVED),
            "comp": flag((due == 0) & paid),
        }
    )


def sold_seats(perf_seat: DataFrame, perfs: DataFrame, sub_lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per sold or reserved seat of the performances with its flags, price type and order date."""
    rows = (
        perf_seat.where(F.col("seat_status").isin(*codes.SEAT_SOLD_OR_HELD))
        .select("perf_no", "zone_no", "seat_no", "seat_status", "sli_no", "order_no")
        .join(perfs.select("perf_no"), "perf_no", "left_semi")
        .join(orders.select("order_no", "order_dt").hint("merge"), "order_no")
        .join(sub_lineitem.select("sli_no", "price_type", "due_amt").hint("merge"), "sli_no")
    )
    return seat_flags(rows).drop("due_amt", "seat_status", "order_no")


def seat_sales(
    perf_seat: DataFrame, perfs: DataFrame, sub_lineitem: DataFrame, orders: DataFrame,
    nett: DataFrame, gst: DataFrame, detail: DataFrame,
) -> DataFrame:
    """One row per sold or reserved seat with its flags, net price and tax.

    For ``perf_seat`` the written rows of ``sold_seats`` may be given.
    """
    rows = perf_seat if "order_dt" in perf_seat.columns else sold_seats(perf_seat, perfs, sub_lineitem, orders)
    # The two joins by price follow each other: one shuffle of the seats serves both.
    for name, prices in (("nett", nett), ("gst", gst)):
        rows = _priced(rows, prices, {"pmap_no": f"{name}_pmap"})
    for name in ("nett", "gst"):
        rows = dependent_left(rows, detail.hint("merge"), ["sli_no"], f"{name}_pmap", "pmap_no", {"paid_amt": name})
    return rows.fillna({"nett": 0, "gst": 0})


def sales_to_date(
    perf_seat: DataFrame, perfs: DataFrame, sub_lineitem: DataFrame, orders: DataFrame,
    nett: DataFrame, gst: DataFrame, detail: DataFrame,
) -> DataFrame:
    """Seats by performance, price type, zone and price; amounts times seats sold."""
    rows = seat_sales(perf_seat, perfs, sub_lineitem, orders, nett, gst, detail)
    grouped = rows.groupBy(*PRICE_KEYS, "nett", "gst").agg(
        F.sum("sold").alias("no_seats_sold"),
        F.sum("reserved").alias("no_seats_reserved"),
        F.sum("comp").alias("no_comps"),
    )
    sold = F.col("no_seats_sold")
    return conform(
        grouped.withColumns({"nett": F.col("nett") * sold, "gst": F.col("gst") * sold}),
        SCHEMAS["sales"],
        sale_ind="TD",
    )


def written_to_date(
    perf_seat: DataFrame, perfs: DataFrame, sub_lineitem: DataFrame, orders: DataFrame,
    nett: DataFrame, gst: DataFrame, detail: DataFrame,
) -> DataFrame:
    """``sales_to_date``, written; the seats that are not priced yet are written before and removed after."""
    spark = perf_seat.sparkSession
    path = shared_path(spark, "stage")
    with stage_scope(spark):
        sold = select_into(sold_seats(perf_seat, perfs, sub_lineitem, orders).drop("seat_no"))
        return select_into(sales_to_date(sold, perfs, sub_lineitem, orders, nett, gst, detail), path)


# --- sales in a date range --------------------------------------------------


def signed_count(code: Column, amount: Column) -> Column:
    """Seats an event adds or takes away; NULL for events that do neither."""
    return (
        F.when(code == codes.EVENT_PAID, 1)
        .when(code == codes.EVENT_UNPAID, -1)
        .when(code == codes.EVENT_RETURNED, -1)
        .when((code == codes.EVENT_RELEASED) & (amount == 0), -1)
        .when((code == codes.EVENT_RESERVED) & (amount == 0), 1)
    )


def signed_amount(code: Column, paid: Column, returned: Column) -> Column:
    """Amount of an event: paid counts, unpaid takes back, returned carries its own sign."""
    return (
        F.when(code == codes.EVENT_PAID, paid)
        .when(code == codes.EVENT_UNPAID, -paid)
        .when(code == codes.EVENT_RETURNED, returned)
    )


def placed_events(hist: DataFrame, perfs: DataFrame, perf_seat: DataFrame) -> DataFrame:
    """Events of the performances with the zone of their seat.

    The seats are limited to the performances, and by them the events.
    """
    places = perf_seat.select("perf_no", "seat_no", "zone_no").join(perfs.select("perf_no"), "perf_no", "left_semi")
    return hist.join(places.hint("merge"), ["perf_no", "seat_no"])


def priced_history(
    hist: DataFrame, perfs: DataFrame, orders: DataFrame, perf_seat: DataFrame, nett: DataFrame
) -> DataFrame:
    """History events of the performances with zone, order date and net price.

    Events that ``events_needed`` has given their zones keep them.
    """
    # Orders keep the joins by performance apart.
    rows = hist if "zone_no" in hist.columns else placed_events(hist, perfs, perf_seat)
    rows = rows.join(orders.select("order_no", "order_dt").hint("merge"), "order_no")
    return _priced(rows, nett, {"pmap_no": "nett_pmap", "price": "nett_price"})


def written_priced(
    hist: DataFrame, perfs: DataFrame, orders: DataFrame, perf_seat: DataFrame, nett: DataFrame,
    start: Moment | None, end: Moment | None,
) -> DataFrame:
    """The priced events that a date range needs, written; the unpriced ones are written before and removed after."""
    spark = hist.sparkSession
    path = shared_path(spark, "stage")
    with stage_scope(spark):
        needed = select_into(events_needed(hist, perfs, start, end, perf_seat))
        return select_into(priced_history(needed, perfs, orders, perf_seat, nett), path)


def original_payment(priced: DataFrame) -> DataFrame:
    """Paid amount and first event date per order, line item and price, from priced events."""
    return (
        priced.where((F.col("event_code") != codes.EVENT_RESERVED) & F.col("nett_pmap").isNotNull())
        .groupBy("order_no", "sli_no", F.col("nett_price").alias("price"))
        .agg(
            F.max("sli_paid_amt").alias("sli_paid_amt"),
            F.min("event_date").alias("orig_event_date"),
        )
    )


def _counted(start: Moment | None, end: Moment | None) -> Column:
    return (
        F.col("event_code").isin(*codes.EVENTS_COUNTED)
        & (F.col("seat_no") > 0)
        & between_open(F.col("event_date"), start, end)
    )


def events_in_range(hist: DataFrame, start: Moment | None, end: Moment | None) -> DataFrame:
    """Events the date range report counts."""
    return hist.where(_counted(start, end))


def events_needed(
    hist: DataFrame, perfs: DataFrame, start: Moment | None, end: Moment | None, perf_seat: DataFrame | None = None
) -> DataFrame:
    """The events that the date range counts, and all others of their line items.

    With ``perf_seat`` they bear the zone of their seat: whole events then meet the
    performances' seats, not the performances first and the seats after. Line
    items are then asked for by their numbers alone, so those that the range counts
    for other performances only may be among the others; no counted event has them.
    """
    if perf_seat is None:
        own = found = hist.join(perfs.select("perf_no"), "perf_no", "left_semi")
    else:
        own, found = placed_events(hist, perfs, perf_seat), hist
    asked = events_in_range(found, start, end).select("sli_no").distinct().withColumn("_asked", F.lit(True))
    known = own.join(asked.hint("merge"), "sli_no", "left")
    return known.where(_counted(start, end) | F.col("_asked")).select(*own.columns)


#: What an event's original payment is found by.
BY_LINE_ITEM, BY_ORDER = ("sli_no",), ("order_no", "sli_no")


def sales_date_range(
    priced: DataFrame, detail: DataFrame, original: DataFrame, start: Moment | None = None,
    end: Moment | None = None, collapse_equal_nett: bool = True,
    original_by: Sequence[str] = BY_LINE_ITEM,
) -> DataFrame:
    """Events in a date range, counted with their sign.

    Groups of one performance, price type and zone whose net totals are equal
    count that total once. ``collapse_equal_nett=False`` adds them up. A line
    item that was paid in several orders meets each of its original payments;
    ``original_by=BY_ORDER`` takes only that of the event's own order.
    """
    sums = price_group_sums(events_in_range(priced, start, end), detail, original, original_by)
    outer = collapsed(sums, (), collapse_equal_nett)
    return conform(outer, SCHEMAS["sales"], sale_ind="DR", no_seats_reserved=0, gst=0)


def now_paid(events: DataFrame, detail: DataFrame) -> DataFrame:
    """Priced events with the amount that their line item's detail holds for their price map."""
    return dependent_left(events, detail.hint("merge"), ["sli_no"], "nett_pmap", "pmap_no", {"paid_amt": "now_paid"})


def price_group_sums(
    events: DataFrame, detail: DataFrame, original: DataFrame, original_by: Sequence[str], extra: Sequence[str] = ()
) -> DataFrame:
    """Seats and net value of priced events by performance, price type, zone, price and amount, and by ``extra``.

    The sums of parts of the events add up to those of all. Events that ``now_paid`` has seen keep its amounts.
    """
    before = original.select(
        *original_by, F.col("price").alias("orig_price"), F.col("sli_paid_amt").alias("orig_paid")
    )
    rows = events.drop("sli_paid_amt")
    rows = rows if "now_paid" in rows.columns else now_paid(rows, detail)
    rows = rows.join(before.hint("merge"), list(original_by), "left")
    code, amount = F.col("event_code"), F.col("amount")
    value = signed_amount(
        code,
        F.coalesce("now_paid", "orig_price"),
        F.coalesce("now_paid", "orig_paid"),
    )
    return rows.groupBy(*extra, *PRICE_KEYS, "nett_price", "amount").agg(
        F.sum(F.coalesce(signed_count(code, amount), F.lit(0))).alias("seats"),
        F.sum(F.coalesce(value, F.lit(0).cast("decimal(19,4)"))).alias("nett"),
    )


def collapsed(sums: DataFrame, extra: Sequence[str], collapse_equal_nett: bool = True) -> DataFrame:
    """Sold and free seats by performance, price type and zone (and ``extra``); equal net totals count once."""
    amount = F.col("amount")
    inner = sums.select(
        *extra, *PRICE_KEYS,
        F.when(amount != 0, F.col("seats")).otherwise(0).alias("sold"),
        F.when(amount == 0, F.col("seats")).otherwise(0).alias("comp"),
        "nett",
    )
    totals = [F.sum("sold").alias("no_seats_sold"), F.sum("comp").alias("no_comps")]
    if collapse_equal_nett:
        return inner.groupBy(*extra, *PRICE_KEYS, "nett").agg(*totals)
    return inner.groupBy(*extra, *PRICE_KEYS).agg(*totals, F.sum("nett").alias("nett"))


# --- seats and holds --------------------------------------------------------
#
# Counted first, restricted to the chosen performances after: few performances,
# which Spark can broadcast, it moves below the count; many meet one row each.


def seat_totals(perf_seat: DataFrame, seat: DataFrame, perfs: DataFrame) -> DataFrame:
    """Capacity and available seats: no wheelchair, standing or blacked-out places."""
    real = seat.where(
        ~F.col("seat_type").isin(codes.SEAT_TYPE_WHEELCHAIR, codes.SEAT_TYPE_STANDING)
    ).select("seat_no")
    return (
        perf_seat.where(
            (F.col("seat_status") != codes.SEAT_BLACKOUT) & F.col("logical_seat_num").isNotNull()
        )
        .select("perf_no", "seat_no", "seat_status")
        .join(real, "seat_no")
        .groupBy("perf_no")
        .agg(
            F.count("seat_no").alias("capacity"),
            F.count_if(F.col("seat_status").isin(*codes.SEAT_AVAILABLE)).alias("available"),
        )
        .join(perfs.select("perf_no"), "perf_no", "left_semi")
    )


def hold_totals(perf_hold: DataFrame, hold_code: DataFrame, perfs: DataFrame) -> DataFrame:
    """Consignments and holds."""
    kind = F.col("type")
    wanted = hold_code.where(kind.isin(codes.HOLD_CONSIGNMENT, *codes.HOLDS)).select("hc_no", "type")
    return (
        perf_hold.select("perf_no", "hc_no")
        .join(wanted, "hc_no")
        .groupBy("perf_no")
        .agg(
            F.count_if(kind == codes.HOLD_CONSIGNMENT).alias("consignment"),
            F.count_if(kind.isin(*codes.HOLDS)).alias("holds"),
        )
        .join(perfs.select("perf_no"), "perf_no", "left_semi")
    )


# --- result -----------------------------------------------------------------


def pivot_sales(
    perfs: DataFrame, sales: DataFrame, holds: DataFrame, seats: DataFrame, sale_end: Moment | None,
    as_of: Moment,
) -> DataFrame:
    """One row per performance; both kinds of sales side by side, absent facts are 0."""
    return conform(
        side_by_side(perfs, sales_by_perf(sales), holds, seats), SCHEMAS["report"],
        sales_snapshot_dt=snapshot_dt(sale_end, as_of),
    )


def sales_by_perf(sales: DataFrame, keys: Sequence[str] = ("perf_no",)) -> DataFrame:
    """Sales of both kinds summed by ``keys``, one column for each measure."""

    def total(kind: str, column: str) -> Column:
        return F.sum(F.when(F.col("sale_ind") == kind, F.col(column)))

    return sales.groupBy(*keys).agg(
        total("DR", "no_seats_sold").alias("DR_tix_count"),
        total("DR", "nett").alias("DR_tix_value"),
        total("TD", "no_seats_sold").alias("TD_tix_count"),
        total("TD", "nett").alias("TD_tix_value"),
        total("TD", "gst").alias("TD_GST_value"),
        total("TD", "no_comps").alias("TD_comp_count"),
        total("TD", "no_seats_reserved").alias("TD_unpaid_count"),
    )


def side_by_side(
    perfs: DataFrame, by_perf: DataFrame, holds: DataFrame, seats: DataFrame, keys: Sequence[str] = ("perf_no",)
) -> DataFrame:
    """Performances with their sales (by ``keys``), holds and seats; absent facts are 0."""
    holds = holds.select(
        "perf_no", F.col("consignment").alias("TD_consig_count"), F.col("holds").alias("TD_holds")
    )
    seats = seats.select(
        "perf_no", F.col("available").alias("TD_available"), F.col("capacity").alias("TD_capacity")
    )
    joined = perfs.join(by_perf, list(keys), "left")
    for facts in (holds, seats):
        joined = joined.join(facts, "perf_no", "left")
    return joined.fillna(0, subset=list(MEASURES))


def report_sales(
    tables: Mapping[str, DataFrame], args: ReportArgs, collapse_equal_nett: bool = True,
    perfs: DataFrame | None = None, original_by: Sequence[str] = BY_LINE_ITEM,
) -> DataFrame:
    """Sales to date and in the date range, one row per price group.

    Price maps and priced events are used more than once and are written once. The other steps are written
    too: what was shuffled for one is gone before the next one runs, and so is what only the next one reads.
    """
    perfs = chosen_perfs(tables, args) if perfs is None else perfs
    maps = [tables[name] for name in ("perf_pmap", "subprice", "pmap")]
    prices = select_into(price_maps(perfs, *maps, (codes.PRICE_NETT, codes.PRICE_GST)))
    nett, gst = of_category(prices, codes.PRICE_NETT), of_category(prices, codes.PRICE_GST)
    hist, orders, perf_seat, detail = (
        tables[name] for name in ("order_seat_hist", "orders", "perf_seat", "sli_detail")
    )
    to_date = written_to_date(perf_seat, perfs, tables["sub_lineitem"], orders, nett, gst, detail)
    spark, dates = hist.sparkSession, (args.sale_start, args.sale_end)
    path = shared_path(spark, "stage")
    with stage_scope(spark):
        priced = written_priced(hist, perfs, orders, perf_seat, nett, *dates)
        in_range = sales_date_range(
            priced, detail, original_payment(priced), *dates, collapse_equal_nett, original_by
        )
        in_range = select_into(in_range, path)
    return to_date.unionByName(in_range)


def chosen_perfs(tables: Mapping[str, DataFrame], args: ReportArgs) -> DataFrame:
    """The performances of a report, written once as every part of it starts from them."""
    found = select_into(
        select_perfs(
            tables["perf"], tables["inventory"], args.season_csv, args.perf_csv, args.perf_start,
            args.perf_end,
        )
    )
    return found.hint("merge") if args.perf_csv is None else found


def sort_report(report: DataFrame) -> DataFrame:
    return report.orderBy("perf_dt", "perf_no")


def promoter_sales(
    tables: Mapping[str, DataFrame], args: ReportArgs, collapse_equal_nett: bool = True
) -> DataFrame:
    """The report, ordered by performance date; empty for the performance list ``"0"``."""
    if args.perf_csv == "0":
        return tables["perf"].sparkSession.createDataFrame([], SCHEMAS["report"])
    perfs = chosen_perfs(tables, args)
    return sort_report(
        pivot_sales(
            perfs,
            report_sales(tables, args, collapse_equal_nett, perfs),
            hold_totals(tables["perf_hold"], tables["hold_code"], perfs),
            seat_totals(tables["perf_seat"], tables["seat"], perfs),
            args.sale_end,
            args.as_of,
        )
    )


def with_totals(report: DataFrame) -> DataFrame:
    """The report and a last row with the sums of its measures, in one pass."""
    labels = [c for c in report.columns if c not in MEASURES and c != "perf_no"]
    total = F.grouping("perf_no")
    out = report.rollup("perf_no").agg(
        total.cast("int").alias("is_total"),
        *[F.when(total == 0, F.max(c)).alias(c) for c in labels],
        *[F.sum(c).alias(c) for c in MEASURES],
    )
    return out.select(*report.columns, "is_total").orderBy("is_total", "perf_dt", "perf_no")
