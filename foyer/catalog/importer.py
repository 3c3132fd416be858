"""Registered queries of the import."""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import codes
from ..functions import (
    add_hours,
    email_pick,
    extended_amount,
    is_blank,
    left_n,
    lower_email,
    map_values,
    padded_dmy,
    parse_dmy,
    parse_dmy_time,
    title_case,
)
from ..operators import (
    append_rows,
    invalid_pairs,
    invalid_reference,
    invalid_values,
    length_overflow,
    lookup_by_prefix,
    missing_required,
    not_in_reference,
    overlapping_validity,
    profile_distinct,
    profile_many,
    reconcile_counts,
    surrogate_key,
    update_from,
    update_where,
)
from ..plans import importer as I
from ..plans.import_job import SOURCES, ImportJob
from ..schemas import SCHEMAS
from ..session import session_folder, shared_path
from ..sources import Loaded, load_staging, read_staging, write_staging
from .binding import Binding
from .registry import query

CREATED_FROM = dt.datetime(2014, 10, 21, 21)
CREATED_TO = dt.datetime(2014, 10, 22)


def _titled(column: str) -> str:
    """Title case over a list of characters, one lambda step per character."""
    c = f"string_split(lower({column}), '')"
    return f"""coalesce(array_to_string(list_transform(list_zip({c}, list_concat([''], {c}), generate_series(1, greatest(len({c}), 1))),
      lambda x: CASE WHEN x[3] = 1 OR (x[3] > 2 AND x[2] IN (' ',';',':','!','?',',','.','_','-','/','&','''','(') AND NOT (x[2] = '''' AND x[1] = 's'))
        THEN CASE WHEN x[1] = 'ß' THEN x[1] ELSE upper(x[1]) END ELSE x[1] END), ''), '')"""


VIEWS = {
    "w_clean": f"""
SELECT s.* REPLACE (
  {", ".join(f"{_titled(c)} AS {c}" for c in I.NAME_COLUMNS)},
  CASE WHEN lower(rtrim(state)) = 'london' THEN NULL ELSE state END AS state,
  CASE lower(rtrim(prefix)) WHEN 'dr' THEN 'Dr.' WHEN 'mr' THEN 'Mr.' WHEN 'mrs' THEN 'Mrs.' WHEN 'ms' THEN 'Ms.' ELSE prefix END AS prefix,
  CASE WHEN length(order_dt) = 9 THEN '0' || order_dt ELSE order_dt END AS order_dt,
  CASE WHEN length(perf_dt) < 19 THEN '0' || perf_dt ELSE perf_dt END AS perf_dt)
FROM v_staging s""",
    "w_keys": """
SELECT legacy_no, row_number() OVER (ORDER BY legacy_no) + 100000 AS customer_no
FROM (SELECT DISTINCT legacy_no FROM v_staging WHERE legacy_no IS NOT NULL) AS d""",
    "w_staged": "SELECT c.*, k.customer_no FROM w_clean c LEFT JOIN w_keys k ON c.legacy_no = k.legacy_no",
    # Checked e-mails; a dead one is none, and takes the buyer's own with it.
    "w_mail": """
SELECT legacy_no, lower(email) AS m_email, coalesce(list_contains(['unreachable', 'illegitimate'], result), false) AS dead FROM v_quality_email""",
    "w_people": f"""
SELECT w_staged.*, coalesce(has_check, false) AS checked, {", ".join(f"q_{c}" for c in (*I.ADDRESS, "phone1", "phone2", "email"))},
  if(coalesce(dead, false), NULL, coalesce(m_email, w_staged.email)) AS eaddress
FROM w_staged LEFT JOIN w_mail USING (legacy_no)
LEFT JOIN (SELECT legacy_no, true AS has_check, {", ".join(f"{c} AS q_{c}" for c in (*I.ADDRESS, "phone1", "phone2", "email"))}
  FROM v_quality_address) AS q USING (legacy_no)""",
    "w_allowed": "SELECT s.id AS state, c.description AS country FROM v_tr_country c JOIN v_tr_state s ON c.id = s.country",
    "w_mapped": """
SELECT a.*, m.price_type_no, z.zone_no FROM w_staged a
LEFT JOIN (SELECT lower(rtrim(matchup_text)) AS t, min(price_type) AS price_type_no FROM v_matchup GROUP BY 1) AS m ON lower(rtrim(left(a.price_type, 30))) = m.t
LEFT JOIN (SELECT lower(rtrim(description)) AS d, min(zone_no) AS zone_no FROM v_zone GROUP BY 1) AS z ON lower(rtrim(a.zone)) = z.d""",
    "w_flags": """
SELECT customer_no, coalesce(lower(rtrim(presenter_email_DNM)) = 'yes', false) AS o1,
  coalesce(lower(rtrim(email_address_decline)) = 'do not email', false) AS o2 FROM w_staged""",
}
_STAGING = ", ".join("CAST(tix_amt AS DOUBLE) AS tix_amt" if f.name == "tix_amt" else f.name for f in SCHEMAS["staging"].fields)


def _load_sql(checked: str, scope: str) -> str:
    address = ", ".join(
        f"CASE WHEN {checked} THEN q_{c} ELSE {c} END AS {'postal_code' if c == 'pcode' else c}" for c in I.ADDRESS
    )
    return f"""SELECT DISTINCT customer_no, prefix, fname, lname, {address}, phone1, phone2, eaddress,
  4 AS original_source_no, legacy_no AS ref_id FROM w_people {scope}"""


def staged(b: Binding) -> DataFrame:
    return I.assign_customer_no(I.clean_staging(b["staging"]))[0]


def staged_buyers(b: Binding) -> DataFrame:
    """Staging for what is loaded per buyer."""
    return I.assign_customer_no(I.clean_staging(I.buyers(b["staging"])))[0]


# --- reading, cleaning, keys -------------------------------------------------


@query(
    "bulk_load_tsv",
    f"SELECT * REPLACE (nullif(email_address_decline, '') AS email_address_decline) FROM (SELECT {_STAGING} FROM v_staging) AS s",
)
def bulk_load_tsv(b):
    """The staging rows written as a tab-separated file and loaded from it."""
    path = shared_path(b.spark, "staging")
    write_staging(b["staging"], path)
    return read_staging(b.spark, path, SCHEMAS["staging"])


@query("clean_staging", f"SELECT {_STAGING} FROM w_clean", VIEWS)
def clean_staging(b):
    return I.clean_staging(b["staging"])


@query(
    "title_case",
    f"""SELECT doc_id, {_titled('text')} AS titled FROM documents""",
)
def title_case_documents(b):
    return b.base("documents").select("doc_id", title_case(F.col("text")).alias("titled"))


@query("title_case_names", f"SELECT legacy_no, order_dt, {_titled('street1')} AS street1, {_titled('street2')} AS street2 FROM v_staging")
def title_case_names(b):
    return b["staging"].select(
        "legacy_no", "order_dt", title_case(F.col("street1")).alias("street1"), title_case(F.col("street2")).alias("street2")
    )


@query("lower_email", "SELECT legacy_no, lower(email) AS email, result FROM v_quality_email")
def lower_emails(b):
    return update_where(b["quality_email"], F.lit(True), {"email": lower_email(F.col("email"))})


@query(
    "code_map",
    """SELECT legacy_no, order_dt, CASE lower(rtrim(prefix)) WHEN 'dr' THEN 'Dr.' WHEN 'mr' THEN 'Mr.' WHEN 'mrs' THEN 'Mrs.'
      WHEN 'ms' THEN 'Ms.' ELSE prefix END AS prefix FROM v_staging""",
)
def code_map(b):
    return b["staging"].select(
        "legacy_no", "order_dt", map_values(F.col("prefix"), codes.PREFIX_FIXES).alias("prefix")
    )


@query(
    "parse_dmy",
    """SELECT legacy_no, CASE WHEN length(order_dt) = 9 THEN '0' || order_dt ELSE order_dt END AS order_text,
      strptime(order_dt, '%d/%m/%Y')::DATE AS order_day, strptime(perf_dt, '%d/%m/%Y %H:%M:%S') AS perf_moment FROM v_staging""",
)
def parse_dates(b):
    return b["staging"].select(
        "legacy_no",
        padded_dmy(F.col("order_dt")).alias("order_text"),
        parse_dmy(F.col("order_dt")).alias("order_day"),
        parse_dmy_time(F.col("perf_dt")).alias("perf_moment"),
    )


@query(
    "surrogate_key",
    "SELECT sli_no, row_number() OVER (ORDER BY sli_no) + 500 AS id FROM (SELECT DISTINCT sli_no FROM v_order_seat_hist) AS d",
)
def surrogate_keys(b):
    return surrogate_key(b["order_seat_hist"], "sli_no", "id", base=500)[0]


@query("running_key", "SELECT * FROM w_keys", VIEWS)
def running_key(b):
    return surrogate_key(b["staging"], "legacy_no", "customer_no")[0]


@query(
    "assign_customer_no",
    "SELECT legacy_no, order_dt, perf_name, customer_no FROM w_staged",
    VIEWS,
)
def assign_customer_no(b):
    return staged(b).select("legacy_no", "order_dt", "perf_name", "customer_no")


@query("next_customer_no", "SELECT count(*) + 100000 + 10 AS next_id FROM w_keys", VIEWS)
def next_customer_no(b):
    return I.assign_customer_no(b["staging"])[1]


@query(
    "max_scalar",
    "SELECT max(customer_no) AS max_customer_no, max(tix_amt)::DOUBLE AS max_amount FROM w_staged",
    VIEWS,
)
def max_scalar(b):
    return staged(b).agg(F.max("customer_no").alias("max_customer_no"), F.max("tix_amt").alias("max_amount"))


# --- checks ------------------------------------------------------------------


@query(
    "invalid_reference",
    """SELECT 'state' AS rule, state AS value, count(*) AS n_towns FROM (SELECT DISTINCT city, state, country FROM v_staging) AS s
      WHERE state IS NOT NULL AND NOT EXISTS (SELECT 1 FROM v_tr_state r WHERE lower(r.id) = lower(s.state)) GROUP BY state
    UNION ALL SELECT DISTINCT 'prefix', prefix, 1 FROM v_staging s
      WHERE prefix IS NOT NULL AND NOT EXISTS (SELECT 1 FROM v_tr_prefix r WHERE lower(r.description) = lower(s.prefix))
    UNION ALL SELECT DISTINCT 'country', country, 1 FROM v_staging s
      WHERE NOT EXISTS (SELECT 1 FROM v_tr_country r WHERE lower(r.description) = lower(s.country))
    UNION ALL SELECT DISTINCT 'price type', price_type, 1 FROM v_staging s
      WHERE NOT EXISTS (SELECT 1 FROM v_matchup r WHERE lower(r.matchup_text) = lower(s.price_type))""",
)
def invalid_references(b):
    rows = b["staging"]
    states = invalid_reference(rows, "state", b["tr_state"], "id", show=["city", "country"])
    towns = states.groupBy(F.lit("state").alias("rule"), F.col("state").alias("value")).agg(
        F.count(F.lit(1)).alias("n_towns")
    )
    others = [
        ("prefix", "prefix", invalid_reference(rows, "prefix", b["tr_prefix"], "description")),
        ("country", "country", invalid_reference(rows, "country", b["tr_country"], "description", keep_null=True)),
        ("price type", "price_type", invalid_reference(rows, "price_type", b["matchup"], "matchup_text", keep_null=True)),
    ]
    for rule, column, bad in others:
        towns = towns.unionByName(
            bad.select(F.lit(rule).alias("rule"), F.col(column).alias("value"), F.lit(1).cast("long").alias("n_towns"))
        )
    return towns


@query(
    "invalid_pair",
    "SELECT DISTINCT city, state, country, pcode FROM v_staging ANTI JOIN w_allowed USING (state, country) WHERE country = 'ASIA'",
    VIEWS,
)
def invalid_pair(b):
    return invalid_pairs(
        b["staging"], "state", "country", b["tr_state"], b["tr_country"], "Asia", show=["city", "pcode"]
    ).select("city", "state", "country", "pcode")


@query(
    "pair_validity_anti",
    """SELECT order_dt, legacy_no, state, country FROM (SELECT *, [lower(state), lower(country)] AS pair FROM v_staging
      WHERE state IS NOT NULL AND country IS NOT NULL) AS s
    ANTI JOIN (SELECT [lower(state), lower(country)] AS pair FROM w_allowed) AS a USING (pair)
    UNION ALL SELECT order_dt, legacy_no, state, country FROM v_staging WHERE state IS NULL OR country IS NULL""",
    VIEWS,
)
def pair_validity_anti(b):
    valid = b["tr_state"].select(F.col("id").alias("state_id"), "country").join(
        b["tr_country"].select(F.col("id").alias("country"), "description"), "country"
    )
    return not_in_reference(
        b["staging"], valid, {"state": "state_id", "country": "description"}, fold=True
    ).select("order_dt", "legacy_no", "state", "country")


_LENGTHS = " UNION ALL ".join(
    f"SELECT '{c}' AS rule, count(*) AS n_rows FROM v_staging WHERE length(rtrim({c})) > {n}"
    for c, n in codes.LENGTH_LIMITS.items()
)
_REQUIRED = """SELECT 'lname_blank' AS rule, count(*) AS n_rows FROM v_staging WHERE coalesce(rtrim(lname), '') = ''
  UNION ALL SELECT 'order_dt_length', count(*) FROM v_staging WHERE length(order_dt) <> 10
  UNION ALL SELECT 'perf_dt_length', count(*) FROM v_staging WHERE length(perf_dt) < 19"""


@query("length_overflow", _LENGTHS)
def length_overflows(b):
    return length_overflow(b["staging"], codes.LENGTH_LIMITS)


@query("missing_required", f"{_LENGTHS} UNION ALL {_REQUIRED}")
def missing_requireds(b):
    return I.staging_checks(b["staging"])


@query(
    "null_blank_filter",
    "SELECT legacy_no, order_dt, lname FROM v_staging WHERE coalesce(rtrim(lname), '') = ''",
)
def null_blank_filter(b):
    return b["staging"].where(is_blank(F.col("lname"))).select("legacy_no", "order_dt", "lname")


@query(
    "customers_without_address",
    """SELECT customer_no, create_dt FROM v_customer c WHERE create_dt > TIMESTAMP '2014-10-21'
      AND NOT EXISTS (SELECT 1 FROM v_address a WHERE a.customer_no = c.customer_no)""",
)
def customers_without_address(b):
    return I.customers_without_address(b["customer"], b["address"], "2014-10-21").select("customer_no", "create_dt")


@query(
    "reconcile_counts",
    """SELECT rule, expected, actual, expected IS NOT DISTINCT FROM actual AS ok FROM (
      SELECT 'rows' AS rule, (SELECT count(*) FROM v_orders) AS expected, (SELECT count(*) FROM v_staging) AS actual
      UNION ALL SELECT 'customers', (SELECT count(DISTINCT customer_no) FROM v_web_order), (SELECT count(DISTINCT legacy_no) FROM v_staging)
      UNION ALL SELECT 'refunds', (SELECT count(*) FROM v_contribution), NULL
      UNION ALL SELECT 'blank names', NULL, (SELECT count(*) FROM v_staging WHERE coalesce(rtrim(lname), '') = '')
      UNION ALL SELECT 'tickets', NULL, (SELECT sum(no_tix)::BIGINT FROM v_staging)) AS r""",
)
def reconcile(b):
    actual = (
        b["staging"]
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.countDistinct("legacy_no").alias("customers"),
            F.count_if(F.coalesce(F.rtrim("lname"), F.lit("")) == "").alias("blank names"),
            F.sum("no_tix").alias("tickets"),
        )
        .unpivot([], ["rows", "customers", "blank names", "tickets"], "rule", "n_rows")
    )
    orders = b["web_order"].agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("customer_no").alias("customers"))
    gifts = b["contribution"].agg(F.count(F.lit(1)).alias("refunds"))
    expected = orders.unpivot([], ["rows", "customers"], "rule", "n_rows").union(gifts.unpivot([], ["refunds"], "rule", "n_rows"))
    return reconcile_counts(actual, expected)


@query(
    "overlapping_validity",
    """SELECT DISTINCT a.customer_no FROM v_web_order a JOIN v_web_order b ON a.customer_no = b.customer_no AND a.order_no <> b.order_no
    AND b.order_dt BETWEEN a.order_dt AND a.order_dt + INTERVAL 72 HOURS""",
)
def overlapping(b):
    """Customers with two orders whose three days of validity meet."""
    spans = b["web_order"].select(
        "customer_no", F.col("order_dt").alias("start_dt"), add_hours(F.col("order_dt"), 72).alias("end_dt")
    )
    return overlapping_validity(spans, ["customer_no"])


@query("profile_distinct", "SELECT zone, count(*) AS n_rows FROM v_staging GROUP BY zone")
def profile(b):
    return profile_distinct(b["staging"], "zone")


@query(
    "distinct_rows",
    "SELECT DISTINCT presenter_email_DNM, email_address_decline, mos_category, zone FROM v_staging",
)
def distinct_rows(b):
    return b["staging"].select("presenter_email_DNM", "email_address_decline", "mos_category", "zone").distinct()


@query(
    "order_by_key",
    "SELECT DISTINCT state, city, country FROM v_staging",
)
def order_by_key(b):
    return b["staging"].select("state", "city", "country").distinct().orderBy("state", "city", "country")


# --- customers ---------------------------------------------------------------


@query(
    "email_pick",
    """SELECT order_dt, legacy_no, if(coalesce(dead, false), NULL, coalesce(m_email, email)) AS eaddress
    FROM v_staging LEFT JOIN w_mail USING (legacy_no)""",
    VIEWS,
)
def email_picks(b):
    mail = b["quality_email"].select("legacy_no", lower_email(F.col("email")).alias("checked"), "result")
    return (
        b["staging"]
        .join(mail, "legacy_no", "left")
        .select(
            "order_dt", "legacy_no",
            email_pick(F.col("result"), F.col("checked"), F.col("email")).alias("eaddress"),
        )
    )


@query(
    "primary_customer_load",
    _load_sql("checked", "WHERE NOT EXISTS (SELECT 1 FROM v_loaded z WHERE z.customer_no = w_people.customer_no)"),
    VIEWS,
)
def primary_customer_load(b):
    return I.primary_customer_load(staged_buyers(b), b["quality_address"], b["quality_email"], b["loaded"])


@query(
    "split_load",
    _load_sql("(checked AND customer_no NOT IN (SELECT customer_no FROM v_loaded))", ""),
    VIEWS,
)
def split_load(b):
    return I.primary_customer_load(
        staged_buyers(b), b["quality_address"], b["quality_email"], b["loaded"], reload_with_original=True
    )


@query(
    "enrich_preview",
    "SELECT DISTINCT customer_no, prefix, fname, lname, street1 AS orig_street1, "
    + ", ".join(f"coalesce(q_{c}, {c}) AS {c}" for c in (*I.ADDRESS, "phone1", "phone2", "email"))
    + ", 4 AS original_source_no, legacy_no AS ref_id FROM w_people",
    VIEWS,
)
def enrich_preview(b):
    return I.enrich_preview(staged_buyers(b), b["quality_address"], b["quality_email"])


@query(
    "anti_join",
    "SELECT DISTINCT customer_no, legacy_no FROM w_staged s WHERE NOT EXISTS (SELECT 1 FROM v_loaded z WHERE z.customer_no = s.customer_no)",
    VIEWS,
)
def anti_join(b):
    rows = staged(b).select("customer_no", "legacy_no").distinct()
    return not_in_reference(rows, b["loaded"], {"customer_no": "customer_no"})


@query(
    "like_prefix",
    "SELECT customer_no, phone FROM v_phone WHERE phone LIKE '04%'",
)
def like_prefix(b):
    return b["phone"].where(F.col("phone").startswith(codes.MOBILE_PREFIX)).select("customer_no", "phone")


_MOBILE = """phone LIKE '04%' AND type IN (1, 2) AND lower(created_by) = 'dbo'
  AND create_dt BETWEEN TIMESTAMP '2014-10-21 21:00:00' AND TIMESTAMP '2014-10-22'
  AND customer_no IN (SELECT customer_no FROM v_address WHERE country = 227)"""


@query(
    "phone_reclass",
    f"""SELECT customer_no, phone, CASE WHEN {_MOBILE} THEN 5 ELSE type END AS type,
      CASE WHEN {_MOBILE} THEN NULL ELSE address_no END AS address_no, created_by, create_dt FROM v_phone""",
)
def phone_reclass(b):
    return I.phone_reclass(b["phone"], b["address"], CREATED_FROM, CREATED_TO)


@query(
    "update_where",
    "SELECT customer_no, phone, CASE WHEN lower(created_by) = 'dbo' THEN 'import' ELSE created_by END AS created_by FROM v_phone",
)
def update_wheres(b):
    own = F.lower("created_by") == codes.IMPORT_USER
    return update_where(b["phone"], own, {"created_by": F.lit("import")}).select(
        "customer_no", "phone", "created_by"
    )


@query("legacy_keyword", "SELECT DISTINCT 404 AS keyword_no, customer_no, CAST(legacy_no AS VARCHAR) AS key_value FROM w_staged", VIEWS)
def legacy_keyword(b):
    return I.legacy_keyword(staged(b))


def _preferences_sql(emarket: str) -> str:
    return f"""SELECT c.customer_no, c.create_dt, CASE WHEN f.customer_no IS NULL THEN c.emarket_ind WHEN {emarket} THEN 2 ELSE 4 END AS emarket_ind,
  CASE WHEN f.any_out THEN 4 ELSE c.mail_ind END AS mail_ind
FROM v_customer c LEFT JOIN (SELECT customer_no, bool_or(o1 OR o2) AS any_out, bool_or(NOT o1) OR bool_or(NOT o2) AS lenient
  FROM w_flags GROUP BY customer_no) AS f ON c.customer_no = f.customer_no"""


@query("any_flag_rollup", _preferences_sql("NOT f.lenient"), VIEWS)
def any_flag_rollup(b):
    return I.preferences(b["customer"], staged(b))


@query("preferences", _preferences_sql("NOT f.lenient"), VIEWS)
def preferences(b):
    return I.preferences(b["customer"], staged(b))


@query("preferences_strict", _preferences_sql("f.any_out"), VIEWS)
def strict_preferences(b):
    """The variant that keeps every single opt-out."""
    return I.preferences(b["customer"], staged(b), strict_opt_out=True)


_INTERESTS = """SELECT customer_no, tkw, 'Y' AS selected FROM (
  SELECT DISTINCT c.customer_no FROM v_customer c JOIN w_flags f ON c.customer_no = f.customer_no WHERE NOT o1
  UNION SELECT DISTINCT c.customer_no FROM v_customer c JOIN w_flags f ON c.customer_no = f.customer_no WHERE NOT o2) AS u
CROSS JOIN (VALUES (9), (14)) AS t(tkw)"""


@query("interests", _INTERESTS, VIEWS)
def interests(b):
    return I.interests(b["customer"], staged(b))


@query(
    "union_distinct",
    "SELECT customer_no FROM w_flags WHERE NOT o1 UNION SELECT customer_no FROM w_flags WHERE NOT o2",
    VIEWS,
)
def union_distinct(b):
    presenter, decline = I.opt_outs()
    rows = staged(b)
    return rows.where(~presenter).select("customer_no").union(rows.where(~decline).select("customer_no")).distinct()


@query("constituency_load", "SELECT DISTINCT 3 AS constituency, customer_no FROM w_staged", VIEWS)
def constituency_load(b):
    return I.constituency(staged(b))


@query(
    "constant_columns",
    "SELECT DISTINCT 3 AS constituency, o_custkey AS customer_no FROM orders",
)
def constant_columns(b):
    return I.constituency(b["web_order"])


# --- ticket history ----------------------------------------------------------


@query(
    "price_type_zone_map",
    "SELECT legacy_no, order_dt, price_type, zone, price_type_no, zone_no FROM w_mapped",
    VIEWS,
)
def price_type_zone_map(b):
    mapped, _ = I.map_price_zone(staged(b), b["matchup"], b["zone"])
    return mapped.select("legacy_no", "order_dt", "price_type", "zone", "price_type_no", "zone_no")


@query(
    "unmapped_price_type",
    "SELECT legacy_no, order_dt, price_type FROM w_mapped WHERE price_type_no IS NULL",
    VIEWS,
)
def unmapped_price_type(b):
    _, unmapped = I.map_price_zone(staged(b), b["matchup"], b["zone"])
    return unmapped.select("legacy_no", "order_dt", "price_type")


@query("left_n", "SELECT legacy_no, left(price_type, 30) AS price_text FROM v_staging")
def left_30(b):
    return b["staging"].select("legacy_no", left_n(F.col("price_type"), 30).alias("price_text"))


@query("lookup_prefix_key", "SELECT legacy_no, order_dt, price_type_no FROM w_mapped", VIEWS)
def lookup_prefix_key(b):
    rows = b["staging"].withColumn("price_type_no", F.lit(None).cast("int"))
    filled = lookup_by_prefix(rows, b["matchup"], "price_type", "matchup_text", "price_type", "price_type_no")
    return filled.select("legacy_no", padded_dmy(F.col("order_dt")).alias("order_dt"), "price_type_no")


@query(
    "update_from_join",
    """SELECT a.legacy_no, a.order_dt, CASE WHEN b.legacy_no IS NOT NULL THEN b.city ELSE a.city END AS city,
      CASE WHEN b.legacy_no IS NOT NULL THEN b.phone2 ELSE a.phone2 END AS phone2
    FROM v_staging a LEFT JOIN v_quality_address b ON a.legacy_no = b.legacy_no""",
)
def update_from_join(b):
    rows = b["staging"].select("legacy_no", "order_dt", "city", "phone2")
    source = b["quality_address"].select("legacy_no", "city", "phone2")
    return update_from(rows, source, ["legacy_no"], {"city": F.col("src_city"), "phone2": F.col("src_phone2")})


_HISTORY = """SELECT 7 AS role, -1 AS perf_no, strptime(perf_dt, '%d/%m/%Y %H:%M:%S') AS perf_dt,
  strptime(order_dt, '%d/%m/%Y')::DATE AS order_dt, customer_no, 8 AS mos, CAST(no_tix * tix_amt AS DOUBLE) AS tck_amt,
  price_type_no AS price_type, perf_name, no_tix AS num_seats, 'P' AS type, 2 AS season, location, 0 AS pkg_no,
  zone_no, 0 AS comp_code, 0 AS order_no, 4 AS theater_no FROM w_mapped"""


def history(b: Binding) -> DataFrame:
    return I.ticket_history(I.map_price_zone(staged(b), b["matchup"], b["zone"])[0])


@query("ticket_history_load", _HISTORY, VIEWS)
def ticket_history_load(b):
    return history(b)


@query("extended_amount", "SELECT legacy_no, CAST(no_tix * tix_amt AS DOUBLE) AS tck_amt FROM v_staging")
def extended_amounts(b):
    return b["staging"].select("legacy_no", extended_amount(F.col("no_tix"), F.col("tix_amt")).alias("tck_amt"))


@query(
    "append_rows",
    """SELECT constituency, customer_no FROM v_const_cust UNION ALL SELECT DISTINCT 3, customer_no FROM w_staged""",
    VIEWS,
)
def append_rows_query(b):
    target = b["const_cust"].select("constituency", "customer_no")
    return append_rows(target, staged(b).select("customer_no").distinct(), constituency=3)


# --- loading with rejects ------------------------------------------------------

#: Every fiftieth order's line has a word for its number of tickets.
_SPOILT = "legacy_no % 50 = 0"


def loaded(b: Binding) -> Loaded:
    """The staging rows written as lines, some of them spoilt, and loaded with rejects and counts."""
    rows = b["staging"]
    spoilt = F.when(F.expr(_SPOILT), F.lit("many")).otherwise(F.col("no_tix").cast("string"))
    path = shared_path(b.spark, "staging")
    write_staging(rows.withColumn("no_tix", spoilt), path)
    required = {"lname_blank": is_blank(F.col("lname"))}
    return load_staging(b.spark, path, SCHEMAS["staging"], codes.LENGTH_LIMITS, required, max_errors=10**9)


@query("load_rejects", f"SELECT CAST(legacy_no AS VARCHAR) AS legacy_no, order_dt FROM v_staging WHERE {_SPOILT}")
def load_rejects(b):
    """The lines that were not loaded."""
    fields = F.split("line", "\t")
    names = SCHEMAS["staging"].fieldNames()
    return loaded(b).rejects.select(*[fields[names.index(c)].alias(c) for c in ("legacy_no", "order_dt")])


@query("load_rows", f"SELECT legacy_no, order_dt, no_tix, CAST(tix_amt AS DOUBLE) AS tix_amt FROM v_staging WHERE NOT {_SPOILT}")
def load_rows(b):
    return loaded(b).rows.select("legacy_no", "order_dt", "no_tix", "tix_amt")


@query(
    "load_counts",
    "SELECT 'rows' AS rule, count(*) AS n_rows FROM w_fine UNION ALL SELECT 'rejects', count(*) FROM v_staging WHERE " + _SPOILT
    + " UNION ALL SELECT 'lname_blank', count(*) FROM w_fine WHERE coalesce(rtrim(lname), '') = ''"
    + "".join(f" UNION ALL SELECT '{c}', count(*) FROM w_fine WHERE length(rtrim({c})) > {n}" for c, n in codes.LENGTH_LIMITS.items()),
    {"w_fine": f"SELECT * FROM v_staging WHERE NOT {_SPOILT}"},
)
def load_counts(b):
    """The checks of the load, counted while the lines were read."""
    return loaded(b).counts


# --- many columns at once -------------------------------------------------------

_PROFILED = ("prefix", "state", "country", "price_type", "zone", "location", "mos_category")


@query(
    "profile_many",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n_rows FROM v_staging GROUP BY {c}" for c in _PROFILED
    ),
)
def profiles(b):
    return profile_many(b["staging"], _PROFILED)


_REFERENCES = {"state": ("tr_state", "id"), "country": ("tr_country", "description"), "zone": ("zone", "description")}


@query(
    "invalid_references",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS n_rows FROM v_staging s WHERE {c} IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM v_{table} r WHERE lower(rtrim(r.{name})) = lower(rtrim(s.{c}))) GROUP BY {c}"""
        for c, (table, name) in _REFERENCES.items()
    ),
)
def invalid_reference_lists(b):
    return invalid_values(b["staging"], {c: (b[table], name) for c, (table, name) in _REFERENCES.items()})


# --- the whole import ------------------------------------------------------------


def import_job(b: Binding) -> ImportJob:
    """The import of a folder's tables: one for a session, taken up by each query that wants a target."""
    path = f"{session_folder(b.spark)}/import-{hashlib.sha256(b.folder.encode()).hexdigest()[:16]}"
    return ImportJob(b.spark, path, b.tables(*SOURCES))


def _target(name: str, sql: str, *columns: str) -> None:
    """Register a target of the job; ``columns`` are those its SQL has, all if none are named."""

    @query(f"import_{name}", sql, VIEWS)
    def run(b: Binding) -> DataFrame:
        found = import_job(b).run()[name]
        return found.select(*columns) if columns else found


_target("staged", "SELECT legacy_no, order_dt, perf_name, customer_no FROM w_staged", "legacy_no", "order_dt", "perf_name", "customer_no")
_target("next_id", "SELECT count(*) + 100000 + 10 AS next_id FROM w_keys")
_target(
    "primary_customer",
    _load_sql("checked", "WHERE NOT EXISTS (SELECT 1 FROM v_loaded z WHERE z.customer_no = w_people.customer_no)"),
)
_target("cust_keyword", "SELECT DISTINCT 404 AS keyword_no, customer_no, CAST(legacy_no AS VARCHAR) AS key_value FROM w_staged")
_target("customer", _preferences_sql("NOT f.lenient"))
_target("cust_interest", _INTERESTS)
_target("ticket_history", _HISTORY)
_target("const_cust", "SELECT DISTINCT 3 AS constituency, customer_no FROM w_staged")
_target("unmapped", "SELECT legacy_no, order_dt, price_type FROM w_mapped WHERE price_type_no IS NULL", "legacy_no", "order_dt", "price_type")
# The job checks the cleaned rows.
_target("checks", f"{_LENGTHS} UNION ALL {_REQUIRED}".replace("v_staging", "w_staged"))


@query(
    "import_manifest",
    """SELECT 'cust_keyword' AS target, count(*) AS n_rows FROM (SELECT DISTINCT customer_no, legacy_no FROM w_staged) AS k
    UNION ALL SELECT 'staged', count(*) FROM w_staged UNION ALL SELECT 'ticket_history', count(*) FROM w_mapped
    UNION ALL SELECT 'customer', count(*) FROM v_customer UNION ALL SELECT 'next_id', 1
    UNION ALL SELECT 'unmapped', count(*) FROM w_mapped WHERE price_type_no IS NULL""",
    VIEWS,
)
def import_manifest(b):
    """Rows of some targets as the job counted them while it wrote."""
    job = import_job(b)
    job.run()
    told = job.manifest().where(F.col("target").isin("cust_keyword", "staged", "ticket_history", "customer", "next_id", "unmapped"))
    return told.select("target", "n_rows")
