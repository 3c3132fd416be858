"""The views of ``binding.py`` as SQL for the check engine.

``with_views`` puts in front of a query the views it names, in order of need.
"""

from __future__ import annotations

import re

from .binding import CONTENT, MATCHUP, PREFIXES, PRICE_TYPES, RULES, VERSIONS, ZONES, literal


def values(rows, columns: str) -> str:
    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({columns})"


_VERSIONS = (
    "(VALUES "
    + ", ".join(
        f"({c}, TIMESTAMP '{s} 00:00:00', TIMESTAMP '{e} 00:00:00', {n}, CAST({share} AS DECIMAL(2,1)))"
        for c, s, e, n, share in VERSIONS
    )
    + ") AS v(price_category, start_dt, end_dt, version, share)"
)

SQL_VIEWS: dict[str, str] = {
    "v_perf": """
SELECT p_partkey AS perf_no, p_brand AS perf_code,
  make_timestamp(1998, 1 + p_partkey % 12, 1 + p_partkey % 28, 19, 30 * (p_partkey % 2), 0.0) AS perf_dt,
  CAST(substr(p_brand, 7) AS BIGINT) AS prod_season_no, p_size AS season FROM part""",
    "v_inventory": "SELECT p_partkey AS inv_no, p_name AS description FROM part",
    "v_season": """
SELECT DISTINCT p_size AS id, 'Season ' || p_size AS description, 1990 + p_size % 10 AS fyear FROM part""",
    "v_perf_pmap": f"""
SELECT p_partkey AS perf_no, p_partkey * 100 + v.version AS pmap_no, v.price_category, t.price_type,
  v.start_dt, v.end_dt
FROM part CROSS JOIN {_VERSIONS}
JOIN (VALUES (1), (2), (3), (4), (5)) AS t(price_type) ON t.price_type <= p_size % 5 + 1""",
    "v_weekly_rate": """
SELECT p_partkey AS perf_no, CAST(k AS INT) AS week, (p_partkey + k) % 97 AS rate, TIMESTAMP '1995-01-02' + k * INTERVAL 7 DAYS AS start_dt,
  TIMESTAMP '1995-01-02' + k * INTERVAL 7 DAYS + CASE WHEN k % 10 = 0 THEN 13 ELSE 6 END * INTERVAL 1 DAY AS end_dt FROM part CROSS JOIN range(208) AS t(k)""",
    "v_subprice": f"""
SELECT p_partkey * 100 + v.version AS pmap_no, 1 AS zmap_no, CAST(z.zone_no AS BIGINT) AS zone_no,
  CAST(CAST(p_retailprice AS DECIMAL(19,4)) * v.share + z.zone_no AS DECIMAL(19,4)) AS price
FROM part CROSS JOIN {_VERSIONS} CROSS JOIN (VALUES (0), (1), (2), (3), (4)) AS z(zone_no)""",
    "v_pmap": f"""
SELECT p_partkey * 100 + v.version AS pmap_no, m.zmap_no, CASE WHEN p_partkey % 11 = 0 THEN 2 ELSE 1 END AS desig_code
FROM part CROSS JOIN {_VERSIONS} CROSS JOIN (VALUES (1), (2)) AS m(zmap_no)""",
    "v_orders": "SELECT o_orderkey AS order_no, o_orderdate AS order_dt FROM orders",
    "v_sli": """
SELECT l_orderkey * 10 + l_linenumber AS sli_no, l_orderkey AS order_no, min(l_partkey) AS perf_no,
  l_linenumber AS price_type, min(l_suppkey) AS seat_no, min(l_suppkey) % 5 AS zone_no,
  CASE min(l_returnflag) WHEN 'A' THEN 13 WHEN 'N' THEN 8 ELSE 7 END AS seat_status,
  CASE WHEN l_linenumber = 7 THEN CAST(0 AS DECIMAL(19,4)) ELSE CAST(max(l_extendedprice) AS DECIMAL(19,4)) END AS due_amt
FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "v_sub_lineitem": """
SELECT sli_no, order_no, price_type AS li_seq_no, perf_no, order_no % 3 AS pkg_no, price_type, due_amt,
  due_amt AS paid_amt FROM v_sli""",
    "v_perf_seat": """
SELECT perf_no, seat_no, seat_no % 5 AS zone_no,
  CASE seat_no % 10 WHEN 0 THEN 6 WHEN 1 THEN 0 WHEN 2 THEN 3 ELSE arg_max(seat_status, sli_no) END AS seat_status,
  max(sli_no) AS sli_no, max(sli_no) // 10 AS order_no,
  CASE WHEN seat_no % 7 <> 0 THEN seat_no END AS logical_seat_num
FROM v_sli GROUP BY perf_no, seat_no""",
    "v_sli_detail": f"""
SELECT sli_no, perf_no * 100 + v.version AS pmap_no, CAST(due_amt * v.share AS DECIMAL(19,4)) AS paid_amt
FROM v_sli CROSS JOIN {_VERSIONS} WHERE due_amt > 20000 OR v.version <> 12""",
    "v_order_seat_hist": """
SELECT l_orderkey AS order_no,
  (CASE WHEN l_orderkey % 4 = 1 AND l_linenumber = 5 THEN l_orderkey - 1 ELSE l_orderkey END) * 10 + l_linenumber AS sli_no,
  l_partkey AS perf_no, l_linenumber AS price_type, l_suppkey AS seat_no,
  CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 26 WHEN l_returnflag = 'A' THEN 1
       WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 26 WHEN l_returnflag = 'N' THEN 4
       WHEN l_linestatus = 'F' THEN 3 ELSE 27 END AS event_code, l_shipdate AS event_date,
  CASE WHEN l_linenumber = 7 THEN CAST(0 AS DECIMAL(19,4)) ELSE CAST(l_extendedprice AS DECIMAL(19,4)) END AS amount,
  CAST(-1 * l_extendedprice AS DECIMAL(19,4)) AS sli_paid_amt FROM lineitem""",
    "v_seat": "SELECT s_suppkey AS seat_no, s_nationkey % 10 AS seat_type FROM supplier",
    "v_perf_hold": "SELECT l_partkey AS perf_no, CASE WHEN l_returnflag = 'R' THEN l_suppkey % 25 ELSE 1 END AS hc_no FROM lineitem",
    "v_hold_code": "SELECT CAST(n_nationkey AS BIGINT) AS hc_no, n_nationkey % 6 + 1 AS type FROM nation",
    "v_staging": """
SELECT c_custkey AS legacy_no,
  CASE c_custkey % 6 WHEN 0 THEN 'Dr' WHEN 1 THEN 'mr' WHEN 2 THEN 'Mrs.' WHEN 3 THEN 'Ms' WHEN 4 THEN 'Prof' END AS prefix,
  lower(c_mktsegment) || '-' || lower(n_name) || CASE WHEN c_custkey % 9 = 0 THEN ' the younger' ELSE '' END AS fname,
  CASE WHEN c_custkey % 13 = 0 THEN '  ' ELSE c_name END AS lname,
  'UNIT ' || c_custkey || '/o''brien''s st. ' || c_mktsegment AS street1,
  CASE WHEN c_custkey % 2 = 0 THEN '(level ' || (c_custkey % 9) || ') nation''s gate' END AS street2,
  lower(n_name) || ' bay' AS city, CASE WHEN c_nationkey = 7 THEN 'london' ELSE n_name END AS state,
  CAST(c_custkey % 9000 + 1000 AS VARCHAR) AS pcode,
  CASE WHEN c_custkey % 17 = 0 THEN 'ASIA' ELSE r_name END AS country, '04' || c_custkey AS phone1,
  CASE WHEN c_custkey % 3 = 0 THEN '02' || c_custkey END AS phone2, 'User' || c_custkey || '@Example.com' AS email,
  CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2', '3') THEN 'Yes' WHEN substr(o_orderpriority, 1, 1) = '4' THEN 'No' END AS presenter_email_DNM,
  CASE o_orderstatus WHEN 'F' THEN 'Do Not Email' WHEN 'O' THEN '' END AS email_address_decline,
  'Show ' || o_orderstatus AS perf_name, strftime(o_orderdate, '%-d/%m/%Y') || ' 19:30:00' AS perf_dt,
  CAST(o_orderkey % 4 + 1 AS INT) AS no_tix, c_mktsegment || ' standard reserve seating price' AS price_type,
  CASE c_custkey % 4 WHEN 0 THEN 'Premium' WHEN 1 THEN 'Wheelchair Companion' WHEN 2 THEN 'wheelchair' ELSE 'A Reserve' END AS zone,
  'Hall ' || r_name AS location, CAST(o_totalprice AS DECIMAL(19,4)) AS tix_amt, 'WEB' AS source_code,
  CASE WHEN substr(o_orderpriority, 1, 1) = '1' THEN 'Online' ELSE 'Box Office' END AS mos_category,
  strftime(o_orderdate, '%-d/%m/%Y') AS order_dt
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
    "v_quality_address": """
SELECT c_custkey AS legacy_no, c_custkey || ' Main St' AS street1, CAST(NULL AS VARCHAR) AS street2,
  'Checked City' AS city, 'State ' || c_nationkey AS state, CAST(c_custkey % 9000 + 1000 AS VARCHAR) AS pcode,
  'Checkland' AS country, CAST(NULL AS VARCHAR) AS phone1, '029' || c_custkey AS phone2,
  CASE WHEN c_custkey % 2 = 0 THEN 'q' || c_custkey || '@example.com' END AS email
FROM customer WHERE c_acctbal > 0""",
    "v_quality_email": """
SELECT c_custkey AS legacy_no, CASE WHEN c_custkey % 7 <> 0 THEN 'M' || c_custkey || '@Example.com' END AS email,
  CASE c_custkey % 6 WHEN 0 THEN 'unreachable' WHEN 1 THEN 'illegitimate' WHEN 2 THEN 'verified' WHEN 3 THEN 'unknown'
    WHEN 4 THEN 'undeliverable' END AS result
FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'""",
    "v_tr_state": "SELECT n_name AS id, n_name AS description, n_regionkey AS country FROM nation",
    "v_tr_country": "SELECT r_regionkey AS id, r_name AS description FROM region",
    "v_tr_prefix": values([(p,) for p in PREFIXES], "description"),
    "v_matchup": values(MATCHUP, "matchup_text, price_type"),
    "v_zone": values(ZONES, "zone_no, description"),
    "v_loaded": "SELECT s_suppkey * 3 + 100001 AS customer_no FROM supplier",
    "v_customer": """
SELECT c_custkey + 100001 AS customer_no,
  TIMESTAMP '2014-10-21 00:00:00' + to_hours(CAST(c_custkey % 48 - 24 AS INT)) AS create_dt, 0 AS emarket_ind,
  c_nationkey % 3 + 1 AS mail_ind FROM customer""",
    "v_phone": """
SELECT c_custkey + 100001 AS customer_no, CASE WHEN c_custkey % 2 = 0 THEN '04' ELSE '02' END || c_custkey AS phone,
  CAST(c_custkey % 3 + 1 AS INT) AS type, c_custkey AS address_no,
  CASE WHEN c_custkey % 5 = 0 THEN 'web' ELSE 'DBO' END AS created_by,
  TIMESTAMP '2014-10-21 20:00:00' + to_hours(CAST(c_custkey % 7 AS INT)) AS create_dt FROM customer""",
    "v_address": """
SELECT c_custkey + 100001 AS customer_no, CASE WHEN c_nationkey % 3 = 0 THEN 227 ELSE 1 END AS country,
  c_custkey || ' Main St' AS street1, c_custkey AS address_no FROM customer WHERE c_mktsegment <> 'BUILDING'""",
    "v_web_order": """
SELECT 'S' || o_orderkey AS sessionkey, o_orderkey AS order_no, o_custkey AS customer_no, o_orderkey % 9 AS source_no,
  CAST(substr(o_orderpriority, 1, 1) AS INT) AS mos, o_orderdate AS order_dt,
  CAST(o_totalprice AS DECIMAL(19,4)) AS order_total FROM orders""",
    "v_web_session": """
SELECT 'S' || o_orderkey AS sessionkey, CAST(substr(o_orderpriority, 1, 1) AS INT) AS mos,
  CASE WHEN o_orderstatus = 'P' THEN 4 ELSE CAST(substr(o_orderpriority, 1, 1) AS INT) END AS originalmos FROM orders""",
    "v_session_variable": """
SELECT * FROM (
  SELECT 'S' || o_orderkey AS sessionkey, 'UserName' AS name, CASE WHEN o_orderstatus = 'F' THEN 'ANONYMOUS' ELSE o_orderpriority END AS value FROM orders
  UNION ALL SELECT 'S' || o_orderkey, 'MOS_changed_from', CASE WHEN o_custkey % 3 = 0 THEN CAST(o_custkey % 5 + 1 AS VARCHAR) END FROM orders
  UNION ALL SELECT 'S' || o_orderkey, 'Gift_Asked', CASE WHEN o_custkey % 4 = 0 AND o_orderkey % 2 = 0 THEN '2' WHEN o_custkey % 4 = 0 THEN '1' END FROM orders
  UNION ALL SELECT 'S' || o_orderkey, 'Round_UP', CASE WHEN o_custkey % 2 = 0 THEN (o_custkey % 500) || '.50' END FROM orders
  UNION ALL SELECT 'S' || o_orderkey, 'PreSelected_Perfs_Loop', CASE WHEN o_custkey % 7 < 2 THEN 'ACTIVE' END FROM orders
) AS s WHERE value IS NOT NULL""",
    "v_web_defaults": "SELECT 'anonymous' AS default_login",
    "v_cart_line": "SELECT l_orderkey AS order_no, l_partkey AS perf_no FROM lineitem",
    "v_cart_line_before": "SELECT l_orderkey AS order_no, CASE WHEN l_linestatus = 'F' THEN l_partkey END AS perf_no FROM lineitem",
    "v_price_type": values(PRICE_TYPES, "id, price_type_group"),
    "v_content": "SELECT id, content_type, mos, constituency, price_type_group, value, CAST(from_dt AS TIMESTAMP) AS from_dt, "
    "CAST(thru_dt AS TIMESTAMP) AS thru_dt, button_text, short_text, long_text, inactive FROM ("
    + values(
        CONTENT,
        "id, content_type, mos, constituency, price_type_group, value, from_dt, thru_dt, button_text, short_text, long_text, inactive",
    )
    + ") AS c",
    "v_message_rule": values(
        RULES, "id, keyword, num_perfs_kwd, num_perfs_total, message_text, disable_checkout, inactive"
    ),
    "v_prod_season": """
SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS prod_season_no, CAST(substr(p_brand, 7) AS BIGINT) % 7 + 100 AS prod_no FROM part""",
    "v_inv_tkw": "SELECT prod_season_no AS inv_no, CAST(prod_season_no % 6 AS INT) AS tkw FROM v_prod_season",
    "v_inv_content": """
SELECT prod_season_no AS inv_no, 9 AS content_type, 's' || prod_season_no || '-9' AS value FROM v_prod_season WHERE prod_season_no % 2 = 0
UNION SELECT prod_season_no, 17, 's' || prod_season_no || '-17' FROM v_prod_season WHERE prod_season_no % 3 = 0
UNION SELECT prod_season_no, 8, 's' || prod_season_no || '-8' FROM v_prod_season WHERE prod_season_no % 5 <> 0
UNION SELECT prod_season_no, 11, 's' || prod_season_no || '-11' FROM v_prod_season WHERE prod_season_no % 4 = 0
UNION SELECT prod_no, 9, 'p' || prod_no || '-9' FROM v_prod_season WHERE prod_no % 2 = 0
UNION SELECT prod_no, 11, 'p' || prod_no || '-11' FROM v_prod_season WHERE prod_no % 3 = 0""",
    "v_const_cust": "SELECT c_nationkey % 9 AS constituency, c_custkey AS customer_no FROM customer",
    "v_contribution": "SELECT o_orderkey AS order_no FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 300000",
    "v_selection": """
SELECT 'S' || o_orderkey AS sessionkey, o_custkey || ',' || (o_orderkey % 30) || ',, ' || (o_custkey + 1) || ',7' AS selection FROM orders""",
    "v_action": """
SELECT 'S' || o_orderkey AS sessionkey, CASE o_orderkey % 6 WHEN 0 THEN o_orderkey % 12 + 1 WHEN 1 THEN 100
  WHEN 2 THEN o_custkey + 901 WHEN 3 THEN o_custkey + 1900000000 WHEN 4 THEN 1999999999 ELSE 1900000000 END AS code FROM orders""",
    "v_price_change": """
SELECT 'S' || l_orderkey AS sessionkey, l_orderkey * 10 + l_linenumber AS sli_no,
  CAST(l_partkey % 5 + 1 AS INT) AS orig_pricetype, l_shipdate AS changed_dt FROM lineitem""",
    "v_changed_prices": """
SELECT 'S' || o_orderkey AS sessionkey, o_orderkey * 10 + 1 AS sli_no, 99 AS orig_pricetype FROM orders WHERE o_orderstatus = 'F'""",
    "v_session_event": """
SELECT CAST(user_id AS VARCHAR) AS sessionkey, event_type AS name, CASE WHEN value >= 1 THEN value END AS value, ts, event_id FROM events""",
}


def with_views(query: str, extra: dict[str, str] | None = None) -> str:
    """``query`` with the views it needs in front; ``extra`` are views of its own."""
    known = {**SQL_VIEWS, **(extra or {})}
    order: list[str] = []

    def need(text: str) -> None:
        for name in re.findall(r"\b[vw]_\w+", text):
            if name in known and name not in order:
                need(known[name])
                if name not in order:
                    order.append(name)

    need(query)
    if not order:
        return query.strip()
    # Shared views are built once per query.
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({known[name].strip()})" for name in order)
    return f"WITH {ctes}\n{query.strip()}"
