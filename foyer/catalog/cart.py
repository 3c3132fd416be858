"""Registered queries of the cart rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import codes
from ..functions import compose_message
from ..operators import (
    binned_date_join,
    counted_bitmaps,
    distinct_bitmaps,
    fallback_pick,
    merged_bitmaps,
    rule_lookup,
    select_into,
    with_settings,
)
from ..plans import cart as C
from ..session import names_below, shared_path
from ..streaming import event_stream
from .basics import ask_sql
from .binding import Binding
from .registry import query

AS_OF = dt.datetime(1998, 8, 1, 10)

VIEWS = {
    "w_kwd": """
SELECT DISTINCT perf_no FROM v_perf SEMI JOIN (
  SELECT inv_no AS prod_season_no FROM v_message_rule JOIN v_inv_tkw ON tkw = keyword WHERE inactive <> 'Y') AS used USING (prod_season_no)""",
    "w_counts": """
SELECT l.order_no, count(DISTINCT l.perf_no) AS total_perfs, count(DISTINCT k.perf_no) AS total_kwd_perfs
FROM v_cart_line l LEFT JOIN w_kwd k ON l.perf_no = k.perf_no GROUP BY l.order_no""",
    "w_last": """
SELECT s.order_no, s.li_seq_no, max(s.perf_no) AS perf_no, max(s.pkg_no) AS pkg_no, max(s.price_type) AS price_type, count(*) AS seats
FROM v_sub_lineitem s JOIN (SELECT order_no, max(coalesce(li_seq_no, 0)) AS m FROM v_sub_lineitem GROUP BY order_no) AS x
  ON s.order_no = x.order_no AND coalesce(s.li_seq_no, 0) = x.m GROUP BY s.order_no, s.li_seq_no""",
    "w_carts": """
SELECT o.sessionkey, o.order_no, o.customer_no, o.source_no, o.order_total, coalesce(s.mos, 0) AS mos,
  coalesce(s.originalmos, 0) AS orig_mos,
  CASE WHEN lower(u.value) = (SELECT lower(min(default_login)) FROM v_web_defaults) THEN 'N' ELSE 'Y' END AS logged_in,
  l.li_seq_no, l.perf_no, l.pkg_no, l.price_type, coalesce(l.seats, 0) AS seats,
  coalesce(n.total_perfs, 0) AS total_perfs, coalesce(n.total_kwd_perfs, 0) AS total_kwd_perfs
FROM v_web_order o JOIN v_web_session s ON o.sessionkey = s.sessionkey
LEFT JOIN (SELECT sessionkey, min(value) AS value FROM v_session_variable WHERE lower(name) = 'username' GROUP BY sessionkey) AS u ON u.sessionkey = o.sessionkey
LEFT JOIN w_last l ON l.order_no = o.order_no LEFT JOIN w_counts n ON n.order_no = o.order_no""",
    # Modes of sale and price type groups, one row.
    "w_modes": """
SELECT max(mos) FILTER (content_type = 'rules_mos') AS rules, max(mos) FILTER (content_type = 'Matinee_MOS') AS matinee,
  max(mos) FILTER (content_type = '3_or_more_PTG') AS package, max(price_type_group) FILTER (content_type = '3_or_more_PTG') AS many,
  max(price_type_group) FILTER (content_type = 'Less_than3_PTG') AS few FROM v_content""",
    "w_moded": """
SELECT c.*, m.*, c.mos IN (m.rules, m.package) AND c.orig_mos <> m.matinee AS packaged,
  if(packaged, c.total_kwd_perfs, NULL) AS seen_kwd FROM w_carts c CROSS JOIN w_modes m""",
    "w_package": "SELECT * FROM w_moded WHERE packaged",
    "w_valid": f"""
SELECT m.perf_no, p.price_type_group, min(m.price_type) AS new_price_type FROM v_perf_pmap m JOIN v_price_type p ON p.id = m.price_type
WHERE TIMESTAMP '{AS_OF}' BETWEEN m.start_dt AND m.end_dt GROUP BY m.perf_no, p.price_type_group""",
    "w_changed": "SELECT sessionkey, min(CAST(value AS INT)) AS from_mos FROM v_session_variable WHERE lower(name) = 'mos_changed_from' GROUP BY sessionkey",
    "w_stored": "SELECT sessionkey, min(CAST(value AS DECIMAL(19,4))) AS stored FROM v_session_variable WHERE lower(name) = 'round_up' GROUP BY sessionkey",
    "w_numbers": """
SELECT DISTINCT sessionkey, CASE WHEN trim(p) = '' THEN 0 ELSE CAST(trim(p) AS INT) END AS number
FROM (SELECT sessionkey, unnest(string_split(selection, ',')[:-2]) AS p FROM v_selection) AS s""",
    "w_items": """
SELECT DISTINCT sessionkey, prod_no AS pd_no, prod_season_no AS pds_no, perf_no, description AS pds_desc, perf_dt
FROM (SELECT perf_no AS number, prod_season_no, perf_no, perf_dt FROM v_perf
  UNION ALL SELECT DISTINCT prod_season_no, prod_season_no, CAST(NULL AS BIGINT), CAST(NULL AS TIMESTAMP) FROM v_perf) AS target
JOIN w_numbers USING (number) JOIN v_prod_season USING (prod_season_no) JOIN v_inventory ON inv_no = number""",
    "w_bought": """
SELECT DISTINCT o.sessionkey, l.perf_no, p.prod_season_no FROM v_web_order o JOIN v_cart_line l ON o.order_no = l.order_no
LEFT JOIN v_perf p ON p.perf_no = l.perf_no""",
    "w_flagged": """
SELECT i.*, CASE WHEN i.perf_no IS NOT NULL THEN EXISTS (SELECT 1 FROM w_bought b WHERE b.sessionkey = i.sessionkey AND b.perf_no = i.perf_no)
  ELSE EXISTS (SELECT 1 FROM w_bought b WHERE b.sessionkey = i.sessionkey AND b.prod_season_no = i.pds_no) END AS in_cart FROM w_items i""",
    "w_bought_before": """
SELECT DISTINCT o.sessionkey, l.perf_no, p.prod_season_no FROM v_web_order o JOIN v_cart_line_before l ON o.order_no = l.order_no
LEFT JOIN v_perf p ON p.perf_no = l.perf_no""",
    "w_open": """
SELECT f.*, f.pds_desc || coalesce(' - ' || strftime(f.perf_dt, '%A, %-d %B, %Y') || ' ' || lpad(strftime(f.perf_dt, '%-I'), 2, ' ')
  || strftime(f.perf_dt, ':%M') || lower(strftime(f.perf_dt, '%p')), '') AS label
FROM w_flagged f WHERE CASE WHEN f.perf_no IS NOT NULL
  THEN NOT EXISTS (SELECT 1 FROM w_bought_before b WHERE b.sessionkey = f.sessionkey AND b.perf_no = f.perf_no)
  ELSE NOT EXISTS (SELECT 1 FROM w_bought_before b WHERE b.sessionkey = f.sessionkey AND b.prod_season_no = f.pds_no) END""",
    "w_rule": """
SELECT num_perfs_kwd AS k, num_perfs_total AS t, coalesce(arg_min(message_text, id), '') AS message_text,
  coalesce(arg_min(coalesce(disable_checkout, 'N'), id), 'N') AS disable_checkout
FROM (SELECT id, num_perfs_kwd, num_perfs_total, coalesce(message_text, '') AS message_text, disable_checkout FROM v_message_rule WHERE inactive <> 'Y') AS r
GROUP BY 1, 2""",
    "w_eligible": """
SELECT c.* FROM w_carts c WHERE NOT EXISTS (SELECT 1 FROM v_const_cust k WHERE k.customer_no = c.customer_no AND k.constituency = 7)
  AND NOT EXISTS (SELECT 1 FROM v_session_variable v WHERE v.sessionkey = c.sessionkey AND lower(v.name) = 'gift_asked' AND v.value = '2')
  AND NOT EXISTS (SELECT 1 FROM v_contribution g WHERE g.order_no = c.order_no)""",
}


def carts(b: Binding) -> DataFrame:
    marked = C.keyword_perfs(b["perf"], b["inv_tkw"], b["message_rule"])
    return C.cart_context(
        b["web_order"], b["web_session"], b["session_variable"], b["web_defaults"],
        b["sub_lineitem"], b["cart_line"], marked,
    )


def _counted(b: Binding) -> DataFrame:
    """Carts with their show counts only."""
    marked = C.keyword_perfs(b["perf"], b["inv_tkw"], b["message_rule"])
    return b["web_order"].join(C.perf_counts(b["cart_line"], marked), "order_no", "left").fillna(
        {"total_perfs": 0, "total_kwd_perfs": 0}
    )


# --- counts and context ------------------------------------------------------


@query("count_distinct_perfs", "SELECT order_no, count(DISTINCT perf_no) AS total_perfs FROM v_cart_line GROUP BY order_no")
def count_distinct_perfs(b):
    return C.distinct_perfs(b["cart_line"])


@query("count_distinct_kwd", "SELECT order_no, total_kwd_perfs FROM w_counts", VIEWS)
def count_distinct_kwd(b):
    return C.distinct_keyword_perfs(b["cart_line"], b["perf"], b["inv_tkw"], b["message_rule"])


@query(
    "distinct_perfs_bitmap",
    """SELECT order_no, count(DISTINCT l.perf_no) AS total_perfs, count(DISTINCT k.perf_no) AS total_kwd_perfs
    FROM (SELECT order_no, perf_no FROM v_cart_line_before UNION ALL SELECT order_no, perf_no FROM v_cart_line) AS l
    LEFT JOIN w_kwd k ON k.perf_no = l.perf_no GROUP BY order_no HAVING count(l.perf_no) > 0""",
    VIEWS,
)
def distinct_perfs_bitmap(b):
    """Yesterday's bitmaps of shows, stored, and today's lines added to them; keyword shows beside all."""
    words = C.keyword_perfs(b["perf"], b["inv_tkw"], b["message_rule"]).withColumn("_marked", F.lit(True))

    def of(lines: DataFrame) -> DataFrame:
        both = lines.select("order_no", "perf_no").join(words, "perf_no", "left")
        kind = F.explode(F.when(F.col("_marked"), F.array(F.lit("all"), F.lit("kwd"))).otherwise(F.array(F.lit("all")))).alias("kind")
        return distinct_bitmaps(both.select("order_no", "perf_no", kind), ["order_no", "kind"], "perf_no")

    merged = merged_bitmaps(select_into(of(b["cart_line_before"])), of(b["cart_line"]))
    counts = counted_bitmaps(merged, ["order_no", "kind"], "n")
    return counts.groupBy("order_no").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).alias(name)
            for kind, name in (("all", "total_perfs"), ("kwd", "total_kwd_perfs"))
        ]
    )


@query("last_line_item", "SELECT * FROM w_last", VIEWS)
def last_line_item(b):
    return C.last_line_item(b["sub_lineitem"])


@query("cart_context", "SELECT * REPLACE (CAST(order_total AS DOUBLE) AS order_total) FROM w_carts", VIEWS)
def cart_context(b):
    return carts(b)


@query(
    "optional_row_join",
    """SELECT order_no, mos, (SELECT mos FROM v_content WHERE content_type = 'rules_mos') AS rules_mos,
      (SELECT mos FROM v_content WHERE content_type = '3_or_more_PTG') AS package_mos,
      (SELECT mos FROM v_content WHERE content_type = 'Less_than3_PTG') AS single_mos FROM v_web_order""",
)
def optional_row_join(b):
    kind = F.col("content_type")
    wanted = {
        "rules_mos": (kind == "rules_mos", "mos"),
        "package_mos": (kind == "3_or_more_PTG", "mos"),
        "single_mos": (kind == "Less_than3_PTG", "mos"),
    }
    return with_settings(b["web_order"].select("order_no", "mos"), b["content"], wanted)


@query(
    "effective_content",
    f"""SELECT o.order_no, o.mos, c.id, c.button_text, c.long_text FROM v_web_order o
    LEFT JOIN (SELECT m.mos AS cart_mos, min(k.id) AS id FROM (SELECT DISTINCT mos FROM v_web_order) AS m
      JOIN v_content k ON coalesce(k.mos, m.mos, 0) = coalesce(m.mos, 0)
      WHERE lower(k.content_type) = 'pre_selected_perfs' AND coalesce(k.inactive, 'N') <> 'Y'
        AND TIMESTAMP '{AS_OF}' BETWEEN coalesce(k.from_dt, TIMESTAMP '2000-01-01')
        AND coalesce(k.thru_dt, TIMESTAMP '2100-12-31') + INTERVAL 23 HOURS GROUP BY m.mos) AS x ON x.cart_mos = o.mos
    LEFT JOIN v_content c ON c.id = x.id""",
)
def effective_content(b):
    rows = b["web_order"].select("order_no", "mos")
    return C.active_content(
        b["content"], rows, "pre_selected_perfs", AS_OF, ["id", "button_text", "long_text"]
    )


def _texts_sql(moment: str) -> str:
    """The selection page's texts of each order, from the content valid at ``moment``, or the defaults."""
    return f"""SELECT o.order_no, o.mos, coalesce(c.button_text, '{codes.DEFAULT_SELECT_BUTTON.replace("'", "''")}') AS button_text,
      coalesce(c.long_text, '{codes.DEFAULT_SELECT_MESSAGE.replace("'", "''")}') AS long_text,
      coalesce(c.short_text, '{codes.DEFAULT_SELECT_DONE.replace("'", "''")}') AS short_text FROM v_web_order o
    LEFT JOIN (SELECT w.order_no, min(k.id) AS id FROM v_web_order w JOIN v_content k ON coalesce(k.mos, w.mos, 0) = coalesce(w.mos, 0)
      WHERE lower(k.content_type) = 'pre_selected_perfs' AND coalesce(k.inactive, 'N') <> 'Y'
        AND {moment} BETWEEN coalesce(k.from_dt, TIMESTAMP '2000-01-01')
        AND coalesce(k.thru_dt, TIMESTAMP '2100-12-31') + INTERVAL 23 HOURS GROUP BY w.order_no) AS x ON x.order_no = o.order_no
    LEFT JOIN v_content c ON c.id = x.id"""


#: Each cart's own moment: some hour of the order's day.
OWN_MOMENT = "(w.order_dt + (w.order_no % 24) * INTERVAL 1 HOUR)"


def timed(df: DataFrame, order_dt: str = "order_dt") -> DataFrame:
    hours = F.make_dt_interval(hours=(F.col("order_no") % 24).cast("int"))
    return df.withColumn("moment", F.col(order_dt).cast("timestamp_ntz") + hours)


@query("preselected_texts_at", _texts_sql(OWN_MOMENT))
def preselected_texts_at(b):
    """Each order's texts at its own moment; content changes between them."""
    orders = timed(b["web_order"]).select("order_no", "mos", "moment")
    return C.selection_texts(b["content"], orders, at="moment").drop("moment")


@query(
    "effective_content_at",
    f"""SELECT o.order_no, min(k.id) AS id FROM v_web_order o
    LEFT JOIN (SELECT w.order_no, k.id FROM v_web_order w JOIN v_content k ON coalesce(k.mos, w.mos, 0) = coalesce(w.mos, 0)
      WHERE lower(k.content_type) = 'pre_selected_perfs' AND coalesce(k.inactive, 'N') <> 'Y'
        AND {OWN_MOMENT} BETWEEN coalesce(k.from_dt, TIMESTAMP '2000-01-01')
        AND coalesce(k.thru_dt, TIMESTAMP '2100-12-31') + INTERVAL 23 HOURS) AS k ON k.order_no = o.order_no GROUP BY o.order_no""",
)
def effective_content_at(b):
    orders = timed(b["web_order"]).select("order_no", "mos", "moment")
    return C.content_at(b["content"], orders, "pre_selected_perfs", "moment", ["id"]).select("order_no", "id")


@query("preselected_texts", _texts_sql(f"TIMESTAMP '{AS_OF}'"))
def preselected_texts(b):
    return C.selection_texts(b["content"], b["web_order"].select("order_no", "mos"), AS_OF)


# --- repricing ---------------------------------------------------------------


@query("min_price_type", "SELECT * FROM w_valid", VIEWS)
def min_price_type(b):
    return C.valid_price_type(b["perf_pmap"], b["price_type"], AS_OF)


@query(
    "reprice_cart",
    """SELECT c.sessionkey, c.order_no, s.sli_no, s.price_type AS old_price_type, v.new_price_type
    FROM w_package c JOIN v_sub_lineitem s ON s.order_no = c.order_no JOIN v_price_type p ON p.id = s.price_type
    JOIN w_valid v ON v.perf_no = s.perf_no AND v.price_type_group = CASE WHEN c.total_perfs >= 3 THEN c.many ELSE c.few END
    WHERE p.price_type_group IN (c.few, c.many) AND s.price_type <> v.new_price_type""",
    VIEWS,
)
def reprice_cart(b):
    return C.reprice(
        carts(b), b["sub_lineitem"], b["perf_pmap"], b["price_type"], b["content"], AS_OF
    )


@query(
    "min_price_type_at",
    f"""SELECT w.order_no, s.sli_no, p.price_type_group, min(m.price_type) AS new_price_type
    FROM v_web_order w JOIN v_sub_lineitem s ON s.order_no = w.order_no JOIN v_perf_pmap m ON m.perf_no = s.perf_no
      AND {OWN_MOMENT} BETWEEN m.start_dt AND m.end_dt JOIN v_price_type p ON p.id = m.price_type
    GROUP BY w.order_no, s.sli_no, p.price_type_group""",
)
def min_price_type_at(b):
    """For every cart line the lowest price type of each group at the cart's moment."""
    moments = timed(b["web_order"]).select("order_no", "moment")
    lines = b["sub_lineitem"].select("order_no", "sli_no", "perf_no").join(moments, "order_no")
    pieces = C.price_type_pieces(b["perf_pmap"], b["price_type"])
    found = binned_date_join(lines, pieces, ["perf_no"], "moment", how="inner")
    return found.select("order_no", "sli_no", "price_type_group", "new_price_type")


@query(
    "reprice_cart_at",
    f"""SELECT c.sessionkey, c.order_no, s.sli_no, s.price_type AS old_price_type, min(m.price_type) AS new_price_type
    FROM w_package c JOIN v_web_order w ON w.order_no = c.order_no JOIN v_sub_lineitem s ON s.order_no = c.order_no
    JOIN v_price_type p ON p.id = s.price_type JOIN v_perf_pmap m ON m.perf_no = s.perf_no
      AND {OWN_MOMENT} BETWEEN m.start_dt AND m.end_dt
    JOIN v_price_type q ON q.id = m.price_type AND q.price_type_group = CASE WHEN c.total_perfs >= 3 THEN c.many ELSE c.few END
    WHERE p.price_type_group IN (c.few, c.many) GROUP BY c.sessionkey, c.order_no, s.sli_no, s.price_type
    HAVING s.price_type <> min(m.price_type)""",
    VIEWS,
)
def reprice_cart_at(b):
    moments = timed(b["web_order"]).select("order_no", "moment")
    return C.reprice_at(
        carts(b).join(moments, "order_no"), b["sub_lineitem"], b["perf_pmap"], b["price_type"], b["content"], "moment"
    )


@query(
    "mos_change",
    """SELECT * FROM (SELECT c.sessionkey, c.mos AS old_mos,
      CASE WHEN c.packaged AND c.total_perfs >= 3 AND c.mos <> c.package AND h.sessionkey IS NULL THEN c.package
        WHEN c.packaged AND c.total_perfs < 3 AND c.mos = c.package AND h.sessionkey IS NOT NULL THEN h.from_mos
        WHEN c.orig_mos = c.matinee AND c.mos <> c.matinee AND h.sessionkey IS NULL THEN c.matinee END AS new_mos
    FROM w_moded c LEFT JOIN w_changed h ON h.sessionkey = c.sessionkey) AS m WHERE new_mos IS NOT NULL""",
    VIEWS,
)
def mos_change(b):
    return C.mos_change(carts(b), b["content"], b["session_variable"])


_AUDIT = """SELECT sessionkey, sli_no, orig_pricetype FROM v_changed_prices
UNION ALL SELECT sessionkey, sli_no, arg_min(orig_pricetype, (changed_dt, orig_pricetype)) FROM v_price_change c
WHERE NOT EXISTS (SELECT 1 FROM v_changed_prices h WHERE h.sessionkey = c.sessionkey AND h.sli_no = c.sli_no) GROUP BY sessionkey, sli_no"""


@query("first_value_audit", _AUDIT)
def first_value_audit(b):
    return C.price_change_audit(b["changed_prices"], b["price_change"], ["changed_dt", "orig_pricetype"])


@query("first_value_audit_stream", _AUDIT)
def first_value_audit_stream(b):
    """The changes as a stream of files, in no order; the first price of a line by the time of its change."""
    path = shared_path(b.spark, "price-changes")
    # As many files as the changes' size asks for; the changes of a line lie in several of them.
    changes = b["price_change"].repartition("sli_no", "changed_dt")
    changes.write.parquet(path)
    files = sum(name.startswith("part-") for name in names_below(b.spark, path))
    # Two batches, whatever the size: each reads the state of its sessions once.
    stream = event_stream(b.spark, path, changes.schema, files_per_batch=max(1, (files + 1) // 2))
    return C.price_change_stream(b["changed_prices"], stream, ["changed_dt", "orig_pricetype"])


@query(
    "price_change_audit",
    """SELECT sessionkey, sli_no, orig_pricetype FROM v_changed_prices
    UNION ALL SELECT c.sessionkey, s.sli_no, s.price_type FROM w_package c JOIN v_sub_lineitem s ON s.order_no = c.order_no
    JOIN v_price_type p ON p.id = s.price_type
    JOIN w_valid v ON v.perf_no = s.perf_no AND v.price_type_group = CASE WHEN c.total_perfs >= 3 THEN c.many ELSE c.few END
    WHERE p.price_type_group IN (c.few, c.many) AND s.price_type <> v.new_price_type
      AND NOT EXISTS (SELECT 1 FROM v_changed_prices h WHERE h.sessionkey = c.sessionkey AND h.sli_no = s.sli_no)""",
    VIEWS,
)
def price_change_audit(b):
    """The changes the repricing proposes, entered into the audit."""
    changes = reprice_cart(b).withColumn("orig_pricetype", F.col("old_price_type"))
    return C.price_change_audit(b["changed_prices"], changes, ["orig_pricetype"])


# --- pre-selected shows ------------------------------------------------------


def selected(b: Binding) -> DataFrame:
    """Shows not in the cart when they were selected."""
    return C.preselected(
        b["selection"], b["perf"], b["prod_season"], b["inventory"], b["web_order"], b["cart_line_before"]
    )


def items(b: Binding) -> DataFrame:
    """The same, marked by the cart as it is now; both looked up in one pass over the lines."""
    return C.preselected_items(
        b["selection"], b["perf"], b["prod_season"], b["inventory"], b["web_order"], b["cart_line_before"], b["cart_line"]
    )


@query("perf_or_season_union", "SELECT * FROM w_items", VIEWS)
def perf_or_season_union(b):
    numbers = C.selection_rows(b["selection"])
    return C.match_selection(numbers, b["perf"], b["prod_season"], b["inventory"])


@query("coalesce_key_join", "SELECT sessionkey, pds_no, perf_no, in_cart FROM w_flagged", VIEWS)
def coalesce_key_join(b):
    numbers = C.selection_rows(b["selection"])
    matched = C.match_selection(numbers, b["perf"], b["prod_season"], b["inventory"])
    flagged = C.in_cart_flag(matched, b["web_order"], b["cart_line"], b["perf"])
    return flagged.select("sessionkey", "pds_no", "perf_no", "in_cart")


@query(
    "preselected_perfs",
    "SELECT sessionkey, pd_no, pds_no, perf_no, pds_desc, perf_dt, label, 'N' AS processed FROM w_open",
    VIEWS,
)
def preselected_perfs(b):
    return selected(b)


@query(
    "preselected_processed",
    """SELECT sessionkey, pd_no, pds_no, perf_no, pds_desc, perf_dt, label, CASE WHEN in_cart THEN 'Y' ELSE 'N' END AS processed
    FROM w_open""",
    VIEWS,
)
def preselected_processed(b):
    return items(b)


_CONTENT = """SELECT i.sessionkey, i.perf_no, i.pds_no,
  coalesce(max(CASE WHEN c.inv_no = i.pds_no AND c.content_type = 9 THEN c.value END), max(CASE WHEN c.inv_no = i.pds_no AND c.content_type = 17 THEN c.value END),
    max(CASE WHEN c.inv_no = i.pd_no AND c.content_type = 9 THEN c.value END), max(CASE WHEN c.inv_no = i.pds_no AND c.content_type = 8 THEN c.value END), '') AS image,
  coalesce(max(CASE WHEN c.inv_no = i.pds_no AND c.content_type = 11 THEN c.value END), max(CASE WHEN c.inv_no = i.pd_no AND c.content_type = 11 THEN c.value END), '') AS synopsis
FROM w_open i LEFT JOIN v_inv_content c ON c.inv_no IN (i.pds_no, i.pd_no) GROUP BY i.sessionkey, i.perf_no, i.pds_no"""


@query("content_fallback", _CONTENT, VIEWS)
def content_fallback(b):
    return C.content_fallback(selected(b), b["inv_content"]).select(
        "sessionkey", "perf_no", "pds_no", "image", "synopsis"
    )


@query(
    "fallback_pick",
    """SELECT p.perf_no, coalesce(min(CASE WHEN c.content_type = 9 THEN c.value END), min(CASE WHEN c.content_type = 8 THEN c.value END), 'none') AS image
    FROM v_perf p LEFT JOIN v_inv_content c ON c.inv_no = p.prod_season_no GROUP BY p.perf_no""",
)
def fallback_picks(b):
    picked = fallback_pick(
        b["perf"], b["inv_content"], {"image": [("prod_season_no", 9), ("prod_season_no", 8)]}, default="none"
    )
    return picked.select("perf_no", "image")


# --- messages and checkout ---------------------------------------------------


@query(
    "multi_key_rule_lookup",
    """SELECT o.order_no, r.id AS rule_id, r.message_text FROM v_web_order o LEFT JOIN w_counts n ON n.order_no = o.order_no
    LEFT JOIN (SELECT num_perfs_kwd, num_perfs_total, min(id) AS id, arg_min(message_text, id) AS message_text
      FROM (SELECT id, num_perfs_kwd, num_perfs_total, coalesce(message_text, '') AS message_text FROM v_message_rule) AS x GROUP BY 1, 2) AS r
    ON r.num_perfs_kwd = coalesce(n.total_kwd_perfs, 0) AND r.num_perfs_total = coalesce(n.total_perfs, 0)""",
    VIEWS,
)
def multi_key_rule_lookup(b):
    rules = b["message_rule"].withColumn("message_text", F.coalesce("message_text", F.lit("")))
    found = rule_lookup(
        _counted(b), rules.withColumnRenamed("id", "rule_id"),
        {"total_kwd_perfs": "num_perfs_kwd", "total_perfs": "num_perfs_total"}, ["rule_id", "message_text"],
    )
    return found.select("order_no", "rule_id", "message_text")


@query(
    "cart_message",
    """SELECT c.sessionkey, c.order_no, r.message_text
      || CASE WHEN EXISTS (SELECT 1 FROM w_open f WHERE f.sessionkey = c.sessionkey AND NOT f.in_cart) THEN ''
         WHEN coalesce(r.disable_checkout, 'N') = 'Y' THEN chr(10) || 'Keep looking Click to Continue Shopping' ELSE chr(10) || 'Keep looking Continue Shopping' END
      || CASE WHEN coalesce(r.disable_checkout, 'N') = 'Y' THEN '' ELSE chr(10) || 'Finished To the till' END AS message,
      coalesce(r.disable_checkout, 'N') AS disable_checkout
    FROM w_moded c LEFT JOIN w_rule r ON r.k = coalesce(c.seen_kwd, 0) AND r.t = c.total_perfs WHERE c.mos IN (c.rules, c.package)""",
    VIEWS,
)
def cart_message(b):
    return C.cart_message(carts(b), b["message_rule"], b["content"], items(b))


@query(
    "compose_message",
    "SELECT o_orderkey, 'Order ' || o_orderkey || ': ' || CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS message FROM orders",
)
def compose_messages(b):
    part = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    message = compose_message("Order ", F.col("o_orderkey").cast("string"), ": ", part)
    return b.base("orders").select("o_orderkey", message.alias("message"))


@query(
    "checkout_min_check",
    """SELECT sessionkey, order_no, total_perfs, (SELECT long_text FROM v_content WHERE content_type = 'Checkout_Limit_Msg') AS message
    FROM w_moded WHERE mos IN (rules, matinee) AND total_perfs < 3 AND seen_kwd IS DISTINCT FROM total_perfs""",
    VIEWS,
)
def checkout_min_check(b):
    return C.checkout_blocked(carts(b), b["content"])


# --- what the rules write into the session -------------------------------------


@query(
    "mos_changed_state",
    """SELECT c.sessionkey, 'MOS_Changed_From' AS name, CAST(c.mos AS VARCHAR) AS value FROM w_moded c ANTI JOIN w_changed USING (sessionkey)
    WHERE (c.packaged AND c.total_perfs >= 3 AND c.mos <> c.package) OR (c.orig_mos = c.matinee AND c.mos <> c.matinee)""",
    VIEWS,
)
def mos_changed_state(b):
    state = b["session_variable"]
    return C.mos_changed_state(C.mos_change(carts(b), b["content"], state), state)


@query(
    "gift_asked_state",
    """SELECT e.sessionkey, 'Gift_Asked' AS name, if(count(v.name) = 0, '1', '2') AS value FROM w_eligible e
    LEFT JOIN v_session_variable v ON v.sessionkey = e.sessionkey AND lower(v.name) = 'gift_asked' GROUP BY e.sessionkey""",
    VIEWS,
)
def gift_asked_state(b):
    return C.gift_asked_state(eligible(b), b["session_variable"])


@query(
    "gift_given_state",
    """SELECT sessionkey, 'Gift_Asked' AS name, '2' AS value FROM v_session_variable SEMI JOIN (SELECT sessionkey FROM v_action
      LEFT JOIN w_stored USING (sessionkey) WHERE code BETWEEN 1900000000 AND 1999999999
      AND if(code = 1999999999, stored, CAST(code - 1900000000 AS DECIMAL(19,4))) BETWEEN 1 AND 999999) AS given USING (sessionkey)
    WHERE lower(name) = 'gift_asked'""",
    VIEWS,
)
def gift_given_state(b):
    state = b["session_variable"]
    return C.gift_given_state(C.decode_gift(b["action"], state, b["content"]), state)


@query(
    "preselected_loop_state",
    """SELECT sessionkey, 'PreSelected_Perfs_Loop' AS name, 'ACTIVE' AS value
    FROM (SELECT DISTINCT sessionkey FROM w_open WHERE NOT in_cart) AS o ANTI JOIN w_looping USING (sessionkey)
    UNION ALL SELECT sessionkey, 'PreSelected_Perfs_Loop', NULL FROM w_looping
    ANTI JOIN (SELECT sessionkey FROM w_open WHERE NOT in_cart) AS o USING (sessionkey)""",
    {**VIEWS, "w_looping": "SELECT DISTINCT sessionkey FROM v_session_variable WHERE lower(name) = 'preselected_perfs_loop'"},
)
def preselected_loop_state(b):
    return C.preselected_loop_state(items(b), b["session_variable"])


@query(
    "preselected_finished_state",
    "SELECT sessionkey, 'Finished_PreSelected_Perf_' || li_seq_no AS name, 'OK' AS value FROM w_carts WHERE li_seq_no IS NOT NULL",
    VIEWS,
)
def preselected_finished_state(b):
    return C.preselected_finished_state(carts(b), b["session_variable"])


# --- gifts -------------------------------------------------------------------


def eligible(b: Binding) -> DataFrame:
    return C.ask_eligible(
        carts(b), b["content"], b["const_cust"], b["session_variable"], b["contribution"]
    )


@query("gift_ask_eligibility", "SELECT sessionkey, order_no, customer_no FROM w_eligible", VIEWS)
def gift_ask_eligibility(b):
    return eligible(b).select("sessionkey", "order_no", "customer_no")


@query(
    "gift_ask",
    f"""SELECT sessionkey, order_no, CAST(order_total AS DOUBLE) AS order_total, CAST(ask / 100 AS DOUBLE) AS ask, target,
      'Round Up Your Order to $' || target AS label
    FROM (SELECT *, CAST(round(order_total + CAST(ask AS DECIMAL(19,4)) * 0.01, 0) AS BIGINT) AS target
      FROM (SELECT *, {ask_sql('order_total')} AS ask FROM w_eligible) AS e) AS f""",
    VIEWS,
)
def gift_ask(b):
    return C.gift_label(C.gift_ask(eligible(b)), b["content"])


_DECODED = """SELECT a.sessionkey, a.code, CASE WHEN a.code BETWEEN 1900000000 AND 1999999999 THEN
  CASE WHEN a.code = 1999999999 THEN s.stored ELSE CAST(a.code - 1900000000 AS DECIMAL(19,4)) END END AS given
FROM v_action a LEFT JOIN w_stored s ON s.sessionkey = a.sessionkey"""
_AMOUNT = "CAST(CASE WHEN given BETWEEN 1 AND 999999 THEN given END AS DOUBLE) AS amount"


@query(
    "decode_amount",
    f"SELECT sessionkey, code, {_AMOUNT} FROM w_decoded WHERE code BETWEEN 1900000000 AND 1999999999",
    {**VIEWS, "w_decoded": _DECODED},
)
def decode_amount(b):
    return C.decode_gift(b["action"], b["session_variable"], b["content"])


@query(
    "route_and_decode",
    f"""SELECT sessionkey, code, CASE WHEN code = 1 THEN 'single_added' WHEN code = 2 THEN 'aux_single_added'
      WHEN code = 3 THEN 'subscription_added' WHEN code = 4 THEN 'aux_subscription_added' WHEN code = 5 THEN 'renewal_added'
      WHEN code = 6 THEN 'aux_renewal_added' WHEN code = 7 THEN 'contribution_added' WHEN code = 8 THEN 'cart_deletion'
      WHEN code = 9 THEN 'checkout' WHEN code = 10 THEN 'login' WHEN code = 100 THEN 'preselected_perfs'
      WHEN code BETWEEN 901 AND 1000000900 THEN 'discount_mode' WHEN code BETWEEN 1900000000 AND 1999999999 THEN 'add_contribution'
      END AS action, {_AMOUNT} FROM w_decoded""",
    {**VIEWS, "w_decoded": _DECODED},
)
def route_and_decode(b):
    return C.route_and_decode(b["action"], b["session_variable"], b["content"])


@query(
    "round_up_state",
    f"""SELECT sessionkey, 'Round_Up' AS name, CAST(CAST(({ask_sql('order_total')}) / 100 AS DECIMAL(19,2)) AS VARCHAR) AS value FROM w_eligible""",
    VIEWS,
)
def round_up_state(b):
    return C.round_up_state(C.gift_ask(eligible(b)))
