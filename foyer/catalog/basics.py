"""Registered queries of the plain operators: tables, set operations, columns, state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    add_hours,
    ask_level,
    month_of,
    pretty_datetime,
    route_action,
    round_up_ask,
    split_csv,
    year_of,
)
from ..operators import conform, delete_where, latest_per_key, select_into
from ..schemas import SCHEMAS
from ..session import shared_path
from ..sources import StoredTable, append_table
from ..streaming import (
    add_totals,
    apply_changes,
    ask_count,
    ask_flag,
    ask_totals,
    event_stream,
    first_rows,
    fold_stream,
    last_rows,
    set_once,
    state_latest,
)
from .binding import Binding, as_session_events
from .registry import query

# --- tables ------------------------------------------------------------------


@query(
    "table_scan",
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
)
def table_scan(b):
    return b.base("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    "create_schema",
    "SELECT sessionkey, name, value FROM v_session_variable",
)
def create_schema(b):
    """Session variables written in their declared schema and read with it."""
    schema = SCHEMAS["session_variable"]
    path = shared_path(b.spark, "session_variable")
    append_table(conform(b["session_variable"], schema), path)
    return b.spark.read.schema(schema).parquet(path)


@query(
    "select_into",
    "SELECT perf_no, count(*) AS n_events, CAST(sum(amount) AS DOUBLE) AS amount FROM v_order_seat_hist GROUP BY perf_no",
)
def select_into_query(b):
    stage = b["order_seat_hist"].groupBy("perf_no").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("amount").alias("amount")
    )
    return select_into(stage)


@query(
    "delete_where",
    "SELECT order_no, sli_no, event_code FROM v_order_seat_hist WHERE NOT (event_code = 27 AND amount > 50000)",
)
def delete_where_query(b):
    gone = (F.col("event_code") == 27) & (F.col("amount") > 50_000)
    return delete_where(b["order_seat_hist"], gone).select("order_no", "sli_no", "event_code")


@query(
    "delete_through_join",
    """SELECT l.order_no, l.perf_no FROM v_cart_line l
    WHERE NOT EXISTS (SELECT 1 FROM v_contribution c WHERE c.order_no = l.order_no)""",
)
def delete_through_join(b):
    return b["cart_line"].join(b["contribution"], "order_no", "left_anti")


# --- stored tables -------------------------------------------------------------


def stored(b: Binding, rows: DataFrame, *keys: str) -> StoredTable:
    """``rows`` as a stored table in the shared folder."""
    return StoredTable(b.spark, shared_path(b.spark, "stored"), rows.schema, keys).create(rows)


@query(
    "stored_update_from",
    """SELECT c.customer_no, c.create_dt, CASE WHEN p.customer_no IS NULL THEN c.emarket_ind ELSE 4 END AS emarket_ind, c.mail_ind
    FROM v_customer c LEFT JOIN (SELECT DISTINCT customer_no FROM v_phone WHERE lower(created_by) = 'dbo') AS p ON p.customer_no = c.customer_no""",
)
def stored_update_from(b):
    """Customers with an imported phone opt out, in the stored table itself."""
    table = stored(b, b["customer"].select("customer_no", "create_dt", "emarket_ind", "mail_ind"), "customer_no")
    own = b["phone"].where(F.lower("created_by") == "dbo").select("customer_no")
    table.merge(own, assign={"emarket_ind": F.lit(4)})
    return table.read()


@query(
    "stored_update_where",
    "SELECT customer_no, phone, CASE WHEN lower(created_by) = 'dbo' THEN 'import' ELSE created_by END AS created_by FROM v_phone",
)
def stored_update_where(b):
    table = stored(b, b["phone"].select("customer_no", "phone", "created_by"), "customer_no")
    table.update(F.lower("created_by") == "dbo", {"created_by": F.lit("import")})
    return table.read()


@query(
    "stored_delete_where",
    "SELECT order_no, sli_no, event_code FROM v_order_seat_hist WHERE NOT (event_code = 27 AND amount > 50000)",
)
def stored_delete_where(b):
    table = stored(b, b["order_seat_hist"].select("order_no", "sli_no", "event_code", "amount"), "order_no")
    table.delete((F.col("event_code") == 27) & (F.col("amount") > 50_000))
    return table.read().drop("amount")


# --- columns -----------------------------------------------------------------


@query(
    "bracket_level",
    """SELECT order_no, CASE WHEN order_total < 100 THEN 10 WHEN order_total < 350 THEN 20 WHEN order_total < 750 THEN 50
      WHEN order_total < 100000 THEN 100 ELSE 10 END AS level FROM v_web_order""",
)
def bracket_level(b):
    return b["web_order"].select("order_no", ask_level(F.col("order_total")).alias("level"))


def ask_sql(total: str) -> str:
    """The ask in whole cents, as SQL over a decimal total."""
    cents = f"CAST({total} * 100 AS BIGINT)"
    level = (
        f"(CASE WHEN {total} < 100 THEN 10 WHEN {total} < 350 THEN 20 WHEN {total} < 750 THEN 50 "
        f"WHEN {total} < 100000 THEN 100 ELSE 10 END)"
    )
    raw = f"((({cents} + {cents} * 2 // 100) // 100) // {level} * {level} * 100 - {cents})"
    return (
        f"CASE WHEN {raw} < ({level} // 3) * 100 THEN {raw} + {level} * 100 WHEN {raw} > {level} * 100 "
        f"THEN {level} * 100 WHEN {raw} = 0 THEN 100 ELSE {raw} END"
    )


@query(
    "round_up_ask",
    f"""SELECT order_no, CAST(({ask_sql('order_total')}) / 100 AS DOUBLE) AS ask,
      CAST(({ask_sql('small_total')}) / 100 AS DOUBLE) AS small_ask
    FROM (SELECT order_no, order_total, CAST(CAST(order_total * 100 AS BIGINT) // 1000 AS DECIMAL(19,4)) * 0.01 AS small_total FROM w_o) AS o""",
    {"w_o": "SELECT order_no, CAST(order_total AS DECIMAL(19,4)) AS order_total FROM v_web_order"},
)
def round_up_asks(b):
    total = F.col("order_total")
    # A thousandth of the total in whole cents, for the lower brackets.
    small = F.expr("cast(order_total * 100 as bigint) div 1000").cast("decimal(19,4)") / 100
    return b["web_order"].select(
        "order_no", round_up_ask(total).alias("ask"), round_up_ask(small).alias("small_ask")
    )


@query(
    "code_route",
    """SELECT sessionkey, code, CASE WHEN code = 1 THEN 'single_added' WHEN code = 2 THEN 'aux_single_added'
      WHEN code = 3 THEN 'subscription_added' WHEN code = 4 THEN 'aux_subscription_added' WHEN code = 5 THEN 'renewal_added'
      WHEN code = 6 THEN 'aux_renewal_added' WHEN code = 7 THEN 'contribution_added' WHEN code = 8 THEN 'cart_deletion'
      WHEN code = 9 THEN 'checkout' WHEN code = 10 THEN 'login' WHEN code = 100 THEN 'preselected_perfs'
      WHEN code BETWEEN 901 AND 1000000900 THEN 'discount_mode' WHEN code BETWEEN 1900000000 AND 1999999999 THEN 'add_contribution'
      END AS action FROM v_action""",
)
def code_route(b):
    return b["action"].select("sessionkey", "code", route_action(F.col("code")).alias("action"))


@query(
    "split_csv_rows",
    """SELECT sessionkey, CASE WHEN trim(p) = '' THEN 0 ELSE CAST(trim(p) AS INT) END AS number
    FROM (SELECT sessionkey, unnest(string_split(selection, ',')[:-2]) AS p FROM v_selection) AS s""",
)
def split_csv_rows(b):
    return b["selection"].select("sessionkey", F.explode(split_csv(F.col("selection"))).alias("number"))


@query(
    "pretty_datetime",
    """SELECT event_id, strftime(ts, '%A, %-d %B, %Y') || ' ' || lpad(strftime(ts, '%-I'), 2, ' ')
      || strftime(ts, ':%M') || lower(strftime(ts, '%p')) AS label FROM events""",
)
def pretty_datetimes(b):
    return b.base("events").select("event_id", pretty_datetime(F.col("ts")).alias("label"))


@query("month_year", "SELECT perf_no, CAST(month(perf_dt) AS INT) AS perf_month, CAST(year(perf_dt) AS INT) AS perf_year FROM v_perf")
def month_year(b):
    return b["perf"].select(
        "perf_no", month_of(F.col("perf_dt")).alias("perf_month"), year_of(F.col("perf_dt")).alias("perf_year")
    )


@query("date_add_hours", "SELECT order_no, order_dt + INTERVAL 23 HOURS AS last_hour FROM v_orders")
def date_add_hours(b):
    return b["orders"].select("order_no", add_hours(F.col("order_dt"), 23).alias("last_hour"))


@query(
    "isnull_coalesce",
    """SELECT o.o_orderkey, coalesce(n.total, 0) AS total_lines FROM orders o
    LEFT JOIN (SELECT l_orderkey, count(*) AS total FROM lineitem GROUP BY l_orderkey) AS n ON n.l_orderkey = o.o_orderkey""",
)
def isnull_coalesce(b):
    lines = b.base("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("total"))
    return (
        b.base("orders")
        .join(lines, "o_orderkey", "left")
        .select("o_orderkey", F.coalesce("total", F.lit(0)).alias("total_lines"))
    )


@query(
    "casts",
    """SELECT CAST(order_no AS VARCHAR) AS order_text, strftime(order_dt, '%Y-%m-%d') AS order_day,
      CAST(CAST(CAST(order_total AS VARCHAR) AS DECIMAL(19,4)) AS DOUBLE) AS total FROM v_web_order""",
)
def casts(b):
    return b["web_order"].select(
        F.col("order_no").cast("string").alias("order_text"),
        F.date_format(F.col("order_dt").cast("date"), "yyyy-MM-dd").alias("order_day"),
        F.col("order_total").cast("string").cast("decimal(19,4)").alias("total"),
    )


@query(
    "top_one",
    """SELECT customer_no, max(order_dt) AS order_dt, arg_max(order_no, (order_dt, order_no)) AS order_no
    FROM v_web_order GROUP BY customer_no""",
)
def top_one(b):
    return latest_per_key(
        b["web_order"], ["customer_no"], ["order_dt", "order_no"], ["order_dt", "order_no"]
    )


# --- session state -----------------------------------------------------------

_LATEST = "SELECT sessionkey, name, arg_max(struct_pack(v := value), (ts, event_id)).v AS value FROM v_session_event GROUP BY sessionkey, name"


@query("session_state_latest", "SELECT * FROM w_latest WHERE value IS NOT NULL", {"w_latest": _LATEST})
def session_state_latest(b):
    return state_latest(b["session_event"])


@query("ask_counter", "SELECT sessionkey, 'Gift_Asked' AS name, CAST(least(count(*), 2) AS VARCHAR) AS value FROM v_session_event WHERE name = 'view' GROUP BY sessionkey")
def ask_counter(b):
    return ask_count(b["session_event"].where(F.col("name") == "view"))


@query(
    "set_once_flag",
    "SELECT sessionkey, name, arg_min(value, (ts, event_id)) AS value FROM v_session_event WHERE value IS NOT NULL GROUP BY sessionkey, name",
)
def set_once_flag(b):
    return set_once(b["session_event"])


@query(
    "state_upsert",
    """SELECT * FROM w_new UNION ALL SELECT * FROM w_first f WHERE name <> 'error'
      AND NOT EXISTS (SELECT 1 FROM w_new n WHERE n.sessionkey = f.sessionkey AND n.name = f.name)""",
    {
        "w_latest": _LATEST,
        "w_new": "SELECT * FROM w_latest WHERE value > 100 AND name <> 'error'",
        "w_first": "SELECT sessionkey, name, arg_min(value, (ts, event_id)) AS value FROM v_session_event WHERE value IS NOT NULL GROUP BY sessionkey, name",
    },
)
def state_upsert(b):
    """First values replaced by late ones above 100; all ``error`` variables deleted."""
    first, late = set_once(b["session_event"]), state_latest(b["session_event"])
    upserts = late.where((F.col("value") > 100) & (F.col("name") != "error"))
    return apply_changes(first, upserts, first.where(F.col("name") == "error"))


@query(
    "stored_upsert",
    """SELECT coalesce(n.sessionkey, f.sessionkey) AS sessionkey, coalesce(n.name, f.name) AS name, coalesce(n.value, f.value) AS value
    FROM w_first f FULL JOIN w_new n ON n.sessionkey = f.sessionkey AND n.name = f.name
    WHERE coalesce(f.name, n.name) <> 'error' OR coalesce(n.value, 0) <= 100""",
    {
        "w_latest": _LATEST,
        "w_new": "SELECT * FROM w_latest WHERE value > 100",
        "w_first": "SELECT sessionkey, name, arg_min(value, (ts, event_id)) AS value FROM v_session_event WHERE value IS NOT NULL AND name <> 'view' GROUP BY sessionkey, name",
    },
)
def stored_upsert(b):
    """First values stored, then late ones above 100 merged in: errors are deleted, others updated or added."""
    first = set_once(b["session_event"].where(F.col("name") != "view"))
    table = stored(b, first, "sessionkey", "name")
    late = state_latest(b["session_event"]).where(F.col("value") > 100)
    table.merge(late, assign={"value": F.col("src_value")}, delete=F.col("name") == "error", insert=True)
    return table.read()


def _events(b: Binding) -> DataFrame:
    schema = b.base("events").schema
    # A pattern, as a stream takes a plain path for a folder and this may be one file.
    return as_session_events(event_stream(b.spark, f"{b.folder}/events.parque[t]", schema))


def _folded(b: Binding, events: DataFrame, prepare, combine) -> DataFrame:
    """The state after the whole stream, kept in buckets of the session."""
    return fold_stream(events, prepare, combine, ["sessionkey"]).read()


@query("session_state_stream", "SELECT * FROM w_latest WHERE value IS NOT NULL", {"w_latest": _LATEST})
def session_state_stream(b):
    state = _folded(b, _events(b), last_rows, last_rows)
    return state.where(F.col("value").isNotNull()).select("sessionkey", "name", "value")


@query("ask_counter_stream", "SELECT sessionkey, 'Gift_Asked' AS name, CAST(least(count(*), 2) AS VARCHAR) AS value FROM v_session_event WHERE name = 'view' GROUP BY sessionkey")
def ask_counter_stream(b):
    return ask_flag(_folded(b, _events(b).where(F.col("name") == "view"), ask_totals, add_totals))


@query(
    "set_once_stream",
    "SELECT sessionkey, name, arg_min(value, (ts, event_id)) AS value FROM v_session_event WHERE value IS NOT NULL GROUP BY sessionkey, name",
)
def set_once_stream(b):
    return _folded(b, _events(b), first_rows, first_rows).select("sessionkey", "name", "value")
