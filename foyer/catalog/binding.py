"""The given tables seen as the ticketing tables, in Spark.

``sql.py`` holds the same views as SQL text for the check engine. Rows are
multiplied by ``explode`` over literal arrays, never by a cross join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import money
from ..operators import select_into
from ..schemas import SCHEMAS
from ..session import shared_path
from ..sources import load

VIEWS: dict[str, Callable[[Binding], DataFrame]] = {}

#: Price map versions: category, valid from, valid to, version number, share of the full price.
VERSIONS = (
    (1, "1995-01-01", "1998-06-30", 11, "0.8"),
    (1, "1998-07-01", "2001-12-31", 12, "0.9"),
    (3, "1995-01-01", "2001-12-31", 31, "0.1"),
)

CONTENT = (
    (1, "rules_mos", 1, None, None, None, None, None, None, None, None, None),
    (2, "Matinee_MOS", 4, None, None, None, None, None, None, None, None, None),
    (3, "3_or_more_PTG", 3, None, 2, None, None, None, None, None, None, None),
    (4, "Less_than3_PTG", None, None, 1, None, None, None, None, None, None, None),
    (5, "Pre_Selected_Perfs", 2, None, None, None, "1998-01-01", None, "Pick", "No more", "Two", None),
    (6, "Pre_Selected_Perfs", None, None, None, None, "1998-07-01", "1998-08-01", "Choose", None, "All", "N"),
    (7, "Pre_Selected_Perfs", 5, None, None, None, None, None, "Off", "Off", "Off", "Y"),
    (8, "Continue_Shopping", None, None, None, None, None, None, "Keep looking", None, None, None),
    (9, "Finished_Shopping", None, None, None, None, None, None, None, "To the till", None, None),
    (10, "Checkout_Limit_Msg", None, None, None, None, None, None, "Back", "More", "Three shows or more.", None),
    (11, "Round_Up_Msg", None, 7, None, 19, None, None, None, None, None, "N"),
)

RULES = (
    (1, 1, 0, 1, "One show: add two. ", "N", "N"),
    (2, 2, 0, 2, "Two shows: add one. ", "Y", "N"),
    (3, 3, 1, 2, None, "Y", "N"),
    (4, 4, 1, 3, "Package price. ", None, "N"),
    (5, 5, 2, 2, "Not in use. ", "Y", "Y"),
    (6, 0, 2, 4, "Unknown use. ", "N", None),
    (7, 1, 0, 1, "Second rule. ", "Y", "N"),
)

PRICE_TYPES = ((1, 1), (2, 1), (3, 2), (4, 2), (5, 3), (6, 3), (7, 3))
PREFIXES = ("Dr.", "Mr.", "Mrs.", "Ms.")
ZONES = ((1, "Premium"), (2, "Wheelchair"), (3, "A Reserve"), (9, "A Reserve"))
MATCHUP = (
    ("AUTOMOBILE standard reserve se", 1),
    ("building standard reserve seat", 2),
    ("FURNITURE standard reserve sea", 3),
    ("MACHINERY standard reserve sea", 4),
    ("MACHINERY standard reserve sea", 5),
)


def literal(value: int | str | None) -> str:
    """A value as SQL text."""
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


#: Where each session has written derived views of a folder, which is not written to while it is read.
_STAGED: dict[tuple[str, str, str], str] = {}


class Binding:
    """Views by name over one folder of tables; each is built once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._built: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        return load(self.spark, self.folder, name)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = VIEWS[name](self)
        return self._built[name]

    def stage(self, *names: str) -> None:
        """Write derived views that the following plan reads more than once; once for all queries of a session."""
        for name in names:
            key = (self.spark.sparkContext.applicationId, self.folder, name)
            if key not in _STAGED:
                _STAGED[key] = shared_path(self.spark, "binding", kept=True)
                select_into(self[name], _STAGED[key])
            self._built[name] = self.spark.read.parquet(_STAGED[key])

    def rows(self, data: tuple[tuple, ...], columns: str) -> DataFrame:
        """A literal table; Spark knows its size, which it does not of a parallelized list."""
        names = ", ".join(c.split()[0] for c in columns.split(", "))
        body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in data)
        typed = [f"CAST({c.split()[0]} AS {c.split()[1]}) AS {c.split()[0]}" for c in columns.split(", ")]
        return self.spark.sql(f"SELECT {', '.join(typed)} FROM VALUES {body} AS t({names})")

    def tables(self, *names: str) -> dict[str, DataFrame]:
        return {n: self[n] for n in names}


def view(build: Callable[[Binding], DataFrame]) -> Callable[[Binding], DataFrame]:
    VIEWS[build.__name__] = build
    return build


def _moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _versions() -> Column:
    return F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(cat).alias("price_category"),
                    _moment(start).alias("start_dt"),
                    _moment(end).alias("end_dt"),
                    F.lit(number).alias("version"),
                    F.lit(share).cast("decimal(2,1)").alias("share"),
                )
                for cat, start, end, number, share in VERSIONS
            ]
        )
    ).alias("v")


# --- report -----------------------------------------------------------------


@view
def perf(b: Binding) -> DataFrame:
    n = F.col("p_partkey")
    return b.base("part").select(
        n.alias("perf_no"),
        F.col("p_brand").alias("perf_code"),
        F.make_timestamp_ntz(
            F.lit(1998), (1 + n % 12).cast("int"), (1 + n % 28).cast("int"), F.lit(19),
            (30 * (n % 2)).cast("int"), F.lit(0),
        ).alias("perf_dt"),
        F.substring("p_brand", 7, 10).cast("long").alias("prod_season_no"),
        F.col("p_size").alias("season"),
    )


@view
def inventory(b: Binding) -> DataFrame:
    return b.base("part").select(F.col("p_partkey").alias("inv_no"), F.col("p_name").alias("description"))


@view
def season(b: Binding) -> DataFrame:
    return (
        b.base("part")
        .select(
            F.col("p_size").alias("id"),
            F.concat(F.lit("Season "), F.col("p_size").cast("string")).alias("description"),
            (F.col("p_size") % 10 + 1990).alias("fyear"),
        )
        .distinct()
    )


@view
def perf_pmap(b: Binding) -> DataFrame:
    offered = F.explode(F.sequence(F.lit(1), F.col("p_size") % 5 + 1))
    return (
        b.base("part")
        .select(F.col("p_partkey").alias("perf_no"), "p_size", _versions())
        .select("perf_no", "v.*", offered.alias("price_type"))
        .select(
            "perf_no", (F.col("perf_no") * 100 + F.col("version")).alias("pmap_no"),
            "price_category", "price_type", "start_dt", "end_dt",
        )
    )


@view
def weekly_rate(b: Binding) -> DataFrame:
    """Four years of weekly rates of each performance; every tenth goes on through the next week."""
    week = F.explode(F.sequence(F.lit(0), F.lit(207))).alias("week")
    start = F.date_add(F.lit("1995-01-02").cast("date"), F.col("week") * 7)
    days = F.when(F.col("week") % 10 == 0, 13).otherwise(6)
    return b.base("part").select(F.col("p_partkey").alias("perf_no"), week).select(
        "perf_no", "week", ((F.col("perf_no") + F.col("week")) % 97).alias("rate"),
        start.cast("timestamp_ntz").alias("start_dt"), F.date_add(start, days).cast("timestamp_ntz").alias("end_dt"),
    )


@view
def subprice(b: Binding) -> DataFrame:
    zone = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long")))
    return (
        b.base("part")
        .select("p_partkey", "p_retailprice", _versions())
        .select("p_partkey", "p_retailprice", "v.version", "v.share", zone.alias("zone_no"))
        .select(
            (F.col("p_partkey") * 100 + F.col("version")).alias("pmap_no"),
            F.lit(1).alias("zmap_no"),
            "zone_no",
            money(money(F.col("p_retailprice")) * F.col("share") + F.col("zone_no")).alias("price"),
        )
    )


@view
def pmap(b: Binding) -> DataFrame:
    return (
        b.base("part")
        .select("p_partkey", _versions())
        .select(
            (F.col("p_partkey") * 100 + F.col("v.version")).alias("pmap_no"),
            F.explode(F.array(F.lit(1), F.lit(2))).alias("zmap_no"),
            F.when(F.col("p_partkey") % 11 == 0, 2).otherwise(1).alias("desig_code"),
        )
    )


@view
def orders(b: Binding) -> DataFrame:
    return b.base("orders").select(
        F.col("o_orderkey").alias("order_no"), F.col("o_orderdate").alias("order_dt")
    )


@view
def sli(b: Binding) -> DataFrame:
    """Line items; the given lines repeat their key, so they are combined."""
    # The flag's letter as a number: a text minimum would make Spark sort the lines.
    flag = F.min(F.ascii("l_returnflag"))
    line = F.col("l_linenumber")
    return (
        b.base("lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.min("l_partkey").alias("perf_no"),
            F.min("l_suppkey").alias("seat_no"),
            F.when(flag == ord("A"), 13).when(flag == ord("N"), 8).otherwise(7).alias("seat_status"),
            F.max("l_extendedprice").alias("_price"),
        )
        .select(
            (F.col("l_orderkey") * 10 + line).alias("sli_no"),
            F.col("l_orderkey").alias("order_no"),
            "perf_no",
            line.alias("price_type"),
            "seat_no",
            (F.col("seat_no") % 5).alias("zone_no"),
            "seat_status",
            F.when(line == 7, money(F.lit(0))).otherwise(money(F.col("_price"))).alias("due_amt"),
        )
    )


@view
def sub_lineitem(b: Binding) -> DataFrame:
    return b["sli"].select(
        "sli_no", "order_no", F.col("price_type").alias("li_seq_no"), "perf_no",
        (F.col("order_no") % 3).alias("pkg_no"), "price_type", "due_amt",
        F.col("due_amt").alias("paid_amt"),
    )


@view
def perf_seat(b: Binding) -> DataFrame:
    seat_no = F.col("seat_no")
    # Line item and status in one number, so the last line brings its status along.
    last = F.max(F.col("sli_no") * 100 + F.col("seat_status")).alias("last")
    sli_no = F.expr("last div 100")
    return (
        b["sli"]
        .groupBy("perf_no", "seat_no")
        .agg(last)
        .select(
            "perf_no",
            "seat_no",
            (seat_no % 5).alias("zone_no"),
            F.when(seat_no % 10 == 0, 6)
            .when(seat_no % 10 == 1, 0)
            .when(seat_no % 10 == 2, 3)
            .otherwise((F.col("last") % 100).cast("int"))
            .alias("seat_status"),
            sli_no.alias("sli_no"),
            F.expr("last div 1000").alias("order_no"),
            F.when(seat_no % 7 != 0, seat_no).alias("logical_seat_num"),
        )
    )


@view
def sli_detail(b: Binding) -> DataFrame:
    return (
        b["sli"]
        .select("sli_no", "perf_no", "due_amt", _versions())
        .where((F.col("due_amt") > 20_000) | (F.col("v.version") != 12))
        .select(
            "sli_no",
            (F.col("perf_no") * 100 + F.col("v.version")).alias("pmap_no"),
            money(F.col("due_amt") * F.col("v.share")).alias("paid_amt"),
        )
    )


@view
def order_seat_hist(b: Binding) -> DataFrame:
    moved = (F.col("l_orderkey") % 4 == 1) & (F.col("l_linenumber") == 5)
    flag, finished = F.col("l_returnflag"), F.col("l_linestatus") == "F"
    price = money(F.col("l_extendedprice"))
    return b.base("lineitem").select(
        F.col("l_orderkey").alias("order_no"),
        # Some line items went on from the order before.
        (F.when(moved, F.col("l_orderkey") - 1).otherwise(F.col("l_orderkey")) * 10 + F.col("l_linenumber")).alias("sli_no"),
        F.col("l_partkey").alias("perf_no"),
        F.col("l_linenumber").alias("price_type"),
        F.col("l_suppkey").alias("seat_no"),
        F.when((flag == "A") & finished, 26)
        .when(flag == "A", 1)
        .when((flag == "N") & finished, 26)
        .when(flag == "N", 4)
        .when(finished, 3)
        .otherwise(27)
        .alias("event_code"),
        F.col("l_shipdate").alias("event_date"),
        F.when(F.col("l_linenumber") == 7, money(F.lit(0))).otherwise(price).alias("amount"),
        money(-price).alias("sli_paid_amt"),
    )


@view
def seat(b: Binding) -> DataFrame:
    return b.base("supplier").select(
        F.col("s_suppkey").alias("seat_no"), (F.col("s_nationkey") % 10).alias("seat_type")
    )


@view
def perf_hold(b: Binding) -> DataFrame:
    # All other lines bear a code of type 2, which the report does not count.
    code = F.when(F.col("l_returnflag") == "R", F.col("l_suppkey") % 25).otherwise(1)
    return b.base("lineitem").select(F.col("l_partkey").alias("perf_no"), code.alias("hc_no"))


@view
def hold_code(b: Binding) -> DataFrame:
    return b.base("nation").select(
        F.col("n_nationkey").cast("long").alias("hc_no"), (F.col("n_nationkey") % 6 + 1).alias("type")
    )


REPORT_TABLES = (
    "perf", "inventory", "perf_pmap", "subprice", "pmap", "orders", "order_seat_hist", "perf_seat",
    "sub_lineitem", "sli_detail", "seat", "perf_hold", "hold_code",
)


# --- import -----------------------------------------------------------------


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


@view
def staging(b: Binding) -> DataFrame:
    """One row per order: the buyer's data as an export would hold them."""
    who, nation = F.col("c_custkey"), F.col("n_name")
    status, priority = F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)
    day = F.col("o_orderdate")
    rows = (
        b.base("orders")
        .join(b.base("customer"), F.col("o_custkey") == who)
        .join(b.base("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(b.base("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    named = rows.select(
        who.alias("legacy_no"),
        F.when(who % 6 == 0, "Dr").when(who % 6 == 1, "mr").when(who % 6 == 2, "Mrs.")
        .when(who % 6 == 3, "Ms").when(who % 6 == 4, "Prof").alias("prefix"),
        F.concat(
            F.lower("c_mktsegment"), F.lit("-"), F.lower(nation),
            F.when(who % 9 == 0, " the younger").otherwise(""),
        ).alias("fname"),
        F.when(who % 13 == 0, "  ").otherwise(F.col("c_name")).alias("lname"),
        _text("UNIT ", who, "/o'brien's st. ", F.col("c_mktsegment")).alias("street1"),
        F.when(who % 2 == 0, _text("(level ", who % 9, ") nation's gate")).alias("street2"),
        _text(F.lower(nation), " bay").alias("city"),
        F.when(F.col("c_nationkey") == 7, "london").otherwise(nation).alias("state"),
        (who % 9000 + 1000).cast("string").alias("pcode"),
        F.when(who % 17 == 0, "ASIA").otherwise(F.col("r_name")).alias("country"),
        _text("04", who).alias("phone1"),
        F.when(who % 3 == 0, _text("02", who)).alias("phone2"),
        _text("User", who, "@Example.com").alias("email"),
        F.when(priority.isin("1", "2", "3"), "Yes").when(priority == "4", "No").alias("presenter_email_DNM"),
        F.when(status == "F", "Do Not Email").when(status == "O", "").alias("email_address_decline"),
        _text("Show ", status).alias("perf_name"),
        _text(F.date_format(day, "d/MM/yyyy"), " 19:30:00").alias("perf_dt"),
        (F.col("o_orderkey") % 4 + 1).cast("int").alias("no_tix"),
        _text(F.col("c_mktsegment"), " standard reserve seating price").alias("price_type"),
        F.when(who % 4 == 0, "Premium").when(who % 4 == 1, "Wheelchair Companion")
        .when(who % 4 == 2, "wheelchair").otherwise("A Reserve").alias("zone"),
        _text("Hall ", F.col("r_name")).alias("location"),
        money(F.col("o_totalprice")).alias("tix_amt"),
        F.lit("WEB").alias("source_code"),
        F.when(priority == "1", "Online").otherwise("Box Office").alias("mos_category"),
        F.date_format(day, "d/MM/yyyy").alias("order_dt"),
    )
    return named.select(*[f.name for f in SCHEMAS["staging"].fields])


@view
def quality_address(b: Binding) -> DataFrame:
    who = F.col("c_custkey")
    return b.base("customer").where(F.col("c_acctbal") > 0).select(
        who.alias("legacy_no"),
        _text(who, " Main St").alias("street1"),
        F.lit(None).cast("string").alias("street2"),
        F.lit("Checked City").alias("city"),
        _text("State ", F.col("c_nationkey")).alias("state"),
        (who % 9000 + 1000).cast("string").alias("pcode"),
        F.lit("Checkland").alias("country"),
        F.lit(None).cast("string").alias("phone1"),
        _text("029", who).alias("phone2"),
        F.when(who % 2 == 0, _text("q", who, "@example.com")).alias("email"),
    )


@view
def quality_email(b: Binding) -> DataFrame:
    who = F.col("c_custkey")
    kind = who % 6
    return b.base("customer").where(F.col("c_mktsegment") != "HOUSEHOLD").select(
        who.alias("legacy_no"),
        F.when(who % 7 != 0, _text("M", who, "@Example.com")).alias("email"),
        F.when(kind == 0, "unreachable").when(kind == 1, "illegitimate").when(kind == 2, "verified")
        .when(kind == 3, "unknown").when(kind == 4, "undeliverable").alias("result"),
    )


@view
def tr_state(b: Binding) -> DataFrame:
    return b.base("nation").select(
        F.col("n_name").alias("id"), F.col("n_name").alias("description"), F.col("n_regionkey").alias("country")
    )


@view
def tr_country(b: Binding) -> DataFrame:
    return b.base("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("description"))


@view
def tr_prefix(b: Binding) -> DataFrame:
    return b.rows(tuple((p,) for p in PREFIXES), "description string")


@view
def matchup(b: Binding) -> DataFrame:
    return b.rows(MATCHUP, "matchup_text string, price_type int")


@view
def zone(b: Binding) -> DataFrame:
    return b.rows(ZONES, "zone_no int, description string")


@view
def loaded(b: Binding) -> DataFrame:
    return b.base("supplier").select((F.col("s_suppkey") * 3 + 100_001).alias("customer_no"))


@view
def customer(b: Binding) -> DataFrame:
    who = F.col("c_custkey")
    return b.base("customer").select(
        (who + 100_001).alias("customer_no"),
        (_moment("2014-10-21 00:00:00") + F.make_interval(hours=(who % 48 - 24).cast("int"))).alias("create_dt"),
        F.lit(0).alias("emarket_ind"),
        (F.col("c_nationkey") % 3 + 1).alias("mail_ind"),
    )


@view
def phone(b: Binding) -> DataFrame:
    who = F.col("c_custkey")
    return b.base("customer").select(
        (who + 100_001).alias("customer_no"),
        F.concat(F.when(who % 2 == 0, "04").otherwise("02"), who.cast("string")).alias("phone"),
        (who % 3 + 1).cast("int").alias("type"),
        who.alias("address_no"),
        F.when(who % 5 == 0, "web").otherwise("DBO").alias("created_by"),
        (_moment("2014-10-21 20:00:00") + F.make_interval(hours=(who % 7).cast("int"))).alias("create_dt"),
    )


@view
def address(b: Binding) -> DataFrame:
    who = F.col("c_custkey")
    return b.base("customer").where(F.col("c_mktsegment") != "BUILDING").select(
        (who + 100_001).alias("customer_no"),
        F.when(F.col("c_nationkey") % 3 == 0, 227).otherwise(1).alias("country"),
        _text(who, " Main St").alias("street1"),
        who.alias("address_no"),
    )


# --- cart -------------------------------------------------------------------


def _session(number: str) -> Column:
    return _text("S", F.col(number)).alias("sessionkey")


def _mos() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("int")


@view
def web_order(b: Binding) -> DataFrame:
    return b.base("orders").select(
        _session("o_orderkey"),
        F.col("o_orderkey").alias("order_no"),
        F.col("o_custkey").alias("customer_no"),
        (F.col("o_orderkey") % 9).alias("source_no"),
        _mos().alias("mos"),
        F.col("o_orderdate").alias("order_dt"),
        money(F.col("o_totalprice")).alias("order_total"),
    )


@view
def web_session(b: Binding) -> DataFrame:
    return b.base("orders").select(
        _session("o_orderkey"),
        _mos().alias("mos"),
        F.when(F.col("o_orderstatus") == "P", 4).otherwise(_mos()).alias("originalmos"),
    )


@view
def session_variable(b: Binding) -> DataFrame:
    who = F.col("o_custkey")

    def variable(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    values = F.array(
        variable(
            "UserName",
            F.when(F.col("o_orderstatus") == "F", "ANONYMOUS").otherwise(F.col("o_orderpriority")),
        ),
        variable("MOS_changed_from", F.when(who % 3 == 0, (who % 5 + 1).cast("string"))),
        variable(
            "Gift_Asked",
            F.when((who % 4 == 0) & (F.col("o_orderkey") % 2 == 0), "2").when(who % 4 == 0, "1"),
        ),
        variable("Round_UP", F.when(who % 2 == 0, _text(who % 500, ".50"))),
        variable("PreSelected_Perfs_Loop", F.when(who % 7 < 2, "ACTIVE")),
    )
    return (
        b.base("orders")
        .select(_session("o_orderkey"), F.explode(values).alias("v"))
        .select("sessionkey", "v.*")
        .where(F.col("value").isNotNull())
    )


@view
def web_defaults(b: Binding) -> DataFrame:
    return b.rows((("anonymous",),), "default_login string")


@view
def cart_line(b: Binding) -> DataFrame:
    return b.base("lineitem").select(F.col("l_orderkey").alias("order_no"), F.col("l_partkey").alias("perf_no"))


@view
def cart_line_before(b: Binding) -> DataFrame:
    """The lines in the carts when the shows were selected; those without a show yet have none."""
    perf_no = F.when(F.col("l_linestatus") == "F", F.col("l_partkey")).alias("perf_no")
    return b.base("lineitem").select(F.col("l_orderkey").alias("order_no"), perf_no)


@view
def price_type(b: Binding) -> DataFrame:
    return b.rows(PRICE_TYPES, "id int, price_type_group int")


@view
def content(b: Binding) -> DataFrame:
    raw = b.rows(
        CONTENT,
        "id int, content_type string, mos int, constituency int, price_type_group int, value int, "
        "from_dt string, thru_dt string, button_text string, short_text string, long_text string, "
        "inactive string",
    )
    return raw.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("from_dt", "thru_dt")})


@view
def message_rule(b: Binding) -> DataFrame:
    return b.rows(
        RULES,
        "id int, keyword int, num_perfs_kwd int, num_perfs_total int, message_text string, "
        "disable_checkout string, inactive string",
    )


@view
def prod_season(b: Binding) -> DataFrame:
    number = F.substring("p_brand", 7, 10).cast("long")
    return (
        b.base("part")
        .select(number.alias("prod_season_no"), (number % 7 + 100).alias("prod_no"))
        .distinct()
    )


@view
def inv_tkw(b: Binding) -> DataFrame:
    return b["prod_season"].select(
        F.col("prod_season_no").alias("inv_no"), (F.col("prod_season_no") % 6).cast("int").alias("tkw")
    )


@view
def inv_content(b: Binding) -> DataFrame:
    own, production = F.col("prod_season_no"), F.col("prod_no")

    def entry(number: Column, kind: int, prefix: str, there: Column) -> Column:
        return F.struct(
            number.alias("inv_no"),
            F.lit(kind).alias("content_type"),
            F.when(there, _text(prefix, number, "-", F.lit(kind))).alias("value"),
        )

    values = F.array(
        entry(own, 9, "s", own % 2 == 0),
        entry(own, 17, "s", own % 3 == 0),
        entry(own, 8, "s", own % 5 != 0),
        entry(own, 11, "s", own % 4 == 0),
        entry(production, 9, "p", production % 2 == 0),
        entry(production, 11, "p", production % 3 == 0),
    )
    return (
        b["prod_season"]
        .select(F.explode(values).alias("v"))
        .select("v.*")
        .where(F.col("value").isNotNull())
        .distinct()
    )


@view
def const_cust(b: Binding) -> DataFrame:
    return b.base("customer").select(
        (F.col("c_nationkey") % 9).alias("constituency"), F.col("c_custkey").alias("customer_no")
    )


@view
def contribution(b: Binding) -> DataFrame:
    given = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 300_000)
    return b.base("orders").where(given).select(F.col("o_orderkey").alias("order_no"))


@view
def selection(b: Binding) -> DataFrame:
    return b.base("orders").select(
        _session("o_orderkey"),
        _text(F.col("o_custkey"), ",", F.col("o_orderkey") % 30, ",, ", F.col("o_custkey") + 1, ",7").alias("selection"),
    )


@view
def action(b: Binding) -> DataFrame:
    key, who = F.col("o_orderkey"), F.col("o_custkey")
    kind = key % 6
    return b.base("orders").select(
        _session("o_orderkey"),
        F.when(kind == 0, key % 12 + 1)
        .when(kind == 1, 100)
        .when(kind == 2, who + 901)
        .when(kind == 3, who + 1_900_000_000)
        .when(kind == 4, 1_999_999_999)
        .otherwise(1_900_000_000)
        .cast("long")
        .alias("code"),
    )


@view
def price_change(b: Binding) -> DataFrame:
    return b.base("lineitem").select(
        _session("l_orderkey"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sli_no"),
        (F.col("l_partkey") % 5 + 1).cast("int").alias("orig_pricetype"),
        F.col("l_shipdate").alias("changed_dt"),
    )


@view
def changed_prices(b: Binding) -> DataFrame:
    """Changes recorded earlier: first lines of finished orders."""
    return b.base("orders").where(F.col("o_orderstatus") == "F").select(
        _session("o_orderkey"),
        (F.col("o_orderkey") * 10 + 1).alias("sli_no"),
        F.lit(99).alias("orig_pricetype"),
    )


@view
def session_event(b: Binding) -> DataFrame:
    return as_session_events(b.base("events"))


def as_session_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").alias("sessionkey"),
        F.col("event_type").alias("name"),
        # A value below one takes the variable away.
        F.when(F.col("value") >= 1, F.col("value")).alias("value"),
        "ts",
        "event_id",
    )
