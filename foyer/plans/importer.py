"""Import of legacy ticket buyers and their ticket history.

Staging holds one row per ticket purchase. A buyer may own any share of it, so
rows are made distinct (combined on the map side) before they meet other
tables wherever the result is per buyer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import codes
from ..functions import (
    email_pick,
    extended_amount,
    lower_email,
    map_values,
    padded_dmy,
    parse_dmy,
    parse_dmy_time,
    same_text,
    text_key,
    title_case,
)
from ..functions.dates import Moment, moment
from ..operators import (
    conform,
    length_overflow,
    lookup_by_prefix,
    lowest_per_key,
    missing_required,
    not_in_reference,
    select_into,
    surrogate_key,
    update_where,
    write_back_key,
)
from ..schemas import SCHEMAS

NAME_COLUMNS = ("city", "street1", "street2", "fname", "lname")


def clean_staging(df: DataFrame) -> DataFrame:
    """Letter case, known value corrections, leading zeros of the dates, in the columns that ``df`` has."""
    fixed = {c: title_case(F.col(c)) for c in NAME_COLUMNS}
    fixed["state"] = map_values(F.col("state"), {codes.STATE_NOT_A_STATE: None})
    fixed["prefix"] = map_values(F.col("prefix"), codes.PREFIX_FIXES)
    fixed["order_dt"] = padded_dmy(F.col("order_dt"))
    fixed["perf_dt"] = padded_dmy(F.col("perf_dt"), with_time=True)
    return df.withColumns({c: value for c, value in fixed.items() if c in df.columns})


def assign_customer_no(df: DataFrame, base: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """Staging with ``customer_no``, and the next free number."""
    keys, next_id = surrogate_key(df, "legacy_no", "customer_no", base)
    return write_back_key(df, keys, "legacy_no"), next_id


PERSON = (
    "customer_no", "legacy_no", "prefix", "fname", "lname", "street1", "street2", "city", "state",
    "pcode", "country", "phone1", "phone2", "email",
)
ADDRESS = ("street1", "street2", "city", "state", "pcode", "country")


def buyers(staging: DataFrame) -> DataFrame:
    """The different buyers of uncleaned staging rows, written once.

    What is loaded per buyer is cleaned and keyed from these: each text once, not once for
    every purchase, and with the same numbers.
    """
    return select_into(staging.select(*[c for c in PERSON if c != "customer_no"]).distinct())


def _people(
    staged: DataFrame, quality_address: DataFrame, quality_email: DataFrame, address_columns: Sequence[str]
) -> DataFrame:
    """Distinct buyers with the checked address (``q_*``) and lower-cased e-mail (``m_*``) rows."""
    address = quality_address.select(
        "legacy_no", *[F.col(c).alias(f"q_{c}") for c in address_columns], F.lit(True).alias("q_found")
    )
    mail = quality_email.select(
        "legacy_no", lower_email(F.col("email")).alias("m_email"), F.col("result").alias("m_result")
    )
    return (
        staged.select(*PERSON).distinct().join(address, "legacy_no", "left").join(mail, "legacy_no", "left")
    )


def primary_customer_load(
    staged: DataFrame,
    quality_address: DataFrame,
    quality_email: DataFrame,
    loaded: DataFrame,
    reload_with_original: bool = False,
) -> DataFrame:
    """Customer rows to load: the checked address as a whole, else the original one.

    Customers already loaded are left out. ``reload_with_original`` loads them
    again with their original address instead.
    """
    people = _people(staged, quality_address, quality_email, ADDRESS)
    checked = F.col("q_found").isNotNull()
    if reload_with_original:
        known = loaded.select("customer_no").distinct().withColumn("_known", F.lit(True))
        people = people.join(known, "customer_no", "left")
        checked = checked & F.col("_known").isNull()
    else:
        people = not_in_reference(people, loaded, {"customer_no": "customer_no"})
    rows = people.withColumns(
        {c: F.when(checked, F.col(f"q_{c}")).otherwise(F.col(c)) for c in ADDRESS}
    ).withColumns(
        {
            "postal_code": F.col("pcode"),
            "eaddress": email_pick(F.col("m_result"), F.col("m_email"), F.col("email")),
            "ref_id": F.col("legacy_no"),
        }
    )
    return conform(
        rows, SCHEMAS["primary_customer"], original_source_no=codes.ORIGINAL_SOURCE
    ).distinct()


def enrich_preview(
    staged: DataFrame, quality_address: DataFrame, quality_email: DataFrame
) -> DataFrame:
    """Checked values field by field, the original where a field is missing."""
    filled = (*ADDRESS, "phone1", "phone2", "email")
    people = _people(staged, quality_address, quality_email, filled)
    return people.select(
        "customer_no", "prefix", "fname", "lname", F.col("street1").alias("orig_street1"),
        *[F.coalesce(F.col(f"q_{c}"), F.col(c)).alias(c) for c in filled],
        F.lit(codes.ORIGINAL_SOURCE).alias("original_source_no"),
        F.col("legacy_no").alias("ref_id"),
    ).distinct()


def phone_reclass(
    phone: DataFrame, address: DataFrame, start: Moment, end: Moment
) -> DataFrame:
    """Mobile numbers stored as landlines by the import become mobiles without address."""
    home = (
        address.where(F.col("country") == codes.HOME_COUNTRY)
        .select("customer_no")
        .distinct()
        .withColumn("_home", F.lit(True))
    )
    moved = (
        F.col("phone").startswith(codes.MOBILE_PREFIX)
        & F.col("type").isin(*codes.LANDLINE_PHONE_TYPES)
        & same_text(F.col("created_by"), F.lit(codes.IMPORT_USER))
        & F.col("create_dt").between(moment(start), moment(end))
        & F.col("_home").isNotNull()
    )
    joined = phone.join(home, "customer_no", "left")
    # Both columns are set from the old row: one statement, not two.
    assign = {"address_no": F.lit(None), "type": F.lit(codes.MOBILE_PHONE_TYPE)}
    return update_where(joined, moved, assign).select(*phone.columns)


def customers_without_address(
    customer: DataFrame, address: DataFrame, since: Moment
) -> DataFrame:
    recent = customer.where(F.col("create_dt") > moment(since))
    return recent.join(address.select("customer_no").distinct(), "customer_no", "left_anti")


def legacy_keyword(staged: DataFrame) -> DataFrame:
    rows = staged.select("customer_no", F.col("legacy_no").alias("key_value")).distinct()
    return conform(rows, SCHEMAS["cust_keyword"], keyword_no=codes.LEGACY_KEYWORD)


def opt_outs() -> tuple[Column, Column]:
    """The two opt-outs of a staging row; no answer is no opt-out."""
    presenter = same_text(F.col("presenter_email_DNM"), F.lit(codes.PRESENTER_OPT_OUT))
    decline = same_text(F.col("email_address_decline"), F.lit(codes.DECLINE_OPT_OUT))
    return F.coalesce(presenter, F.lit(False)), F.coalesce(decline, F.lit(False))


def flag_rollup(staged: DataFrame) -> DataFrame:
    """Per customer: whether any row opts out on any count, and whether all do on both."""
    presenter, decline = opt_outs()
    return staged.groupBy("customer_no").agg(
        F.bool_or(presenter | decline).alias("any_out"), F.bool_and(presenter & decline).alias("all_out")
    )


def preferences(
    customers: DataFrame, staged: DataFrame, strict_opt_out: bool = False
) -> DataFrame:
    """Marketing indicators of the customers that occur in staging.

    A customer keeps the e-mail opt-out only if every row opts out on both
    counts; ``strict_opt_out`` keeps it if any row opts out on either.
    """
    out = F.col("any_out")
    opted = out if strict_opt_out else F.col("all_out")
    email = F.when(opted, codes.MARKETING_OPT_OUT_EMAIL).otherwise(codes.MARKETING_ALLOWED)
    joined = customers.join(flag_rollup(staged), "customer_no", "left").withColumns(
        {
            "emarket_ind": F.when(out.isNotNull(), email).otherwise(F.col("emarket_ind")),
            "mail_ind": F.when(out, codes.MARKETING_ALLOWED).otherwise(F.col("mail_ind")),
        }
    )
    return joined.select(*customers.columns)


def interests(
    customers: DataFrame, staged: DataFrame, interest_codes: Sequence[int] = codes.INTERESTS
) -> DataFrame:
    """Interests for customers with at least one flag that is no opt-out."""
    presenter, decline = opt_outs()
    willing = (
        staged.where(~presenter)
        .select("customer_no")
        .union(staged.where(~decline).select("customer_no"))
        .distinct()
    )
    known = customers.select("customer_no").distinct().join(willing, "customer_no", "left_semi")
    rows = known.withColumn("tkw", F.explode(F.array(*[F.lit(c) for c in interest_codes])))
    return conform(rows, SCHEMAS["cust_interest"], selected="Y")


def map_price_zone(
    staged: DataFrame, matchup: DataFrame, zones: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Numbers for the price type and zone texts, and the rows without a price type."""
    rows = staged.withColumn("price_type_no", F.lit(None).cast("int"))
    rows = lookup_by_prefix(rows, matchup, "price_type", "matchup_text", "price_type", "price_type_no")
    zone = lowest_per_key(
        zones.select(text_key(F.col("description")).alias("_zone"), "zone_no").dropna(),
        ["_zone"],
        ["zone_no"],
    )
    mapped = (
        rows.withColumn("_zone", text_key(F.col("zone"))).join(zone, "_zone", "left").drop("_zone")
    )
    return mapped, mapped.where(F.col("price_type_no").isNull())


def ticket_history(mapped: DataFrame) -> DataFrame:
    """History rows, one per staging row."""
    rows = mapped.select(
        parse_dmy_time(F.col("perf_dt")).alias("perf_dt"),
        parse_dmy(F.col("order_dt")).alias("order_dt"),
        "customer_no",
        extended_amount(F.col("no_tix"), F.col("tix_amt")).alias("tck_amt"),
        F.col("price_type_no").alias("price_type"),
        "perf_name",
        F.col("no_tix").alias("num_seats"),
        "location",
        "zone_no",
    )
    return conform(
        rows, SCHEMAS["ticket_history"],
        role=codes.HISTORY_ROLE, perf_no=codes.HISTORY_PERF_NO, mos=codes.HISTORY_MOS,
        type=codes.HISTORY_TYPE, season=codes.HISTORY_SEASON, pkg_no=codes.HISTORY_PKG_NO,
        comp_code=codes.HISTORY_COMP_CODE, order_no=codes.HISTORY_ORDER_NO,
        theater_no=codes.HISTORY_THEATER_NO,
    )


def constituency(staged: DataFrame) -> DataFrame:
    rows = staged.select("customer_no").distinct()
    return conform(rows, SCHEMAS["const_cust"], constituency=codes.CONSTITUENCY_TICKET_BUYER)


def staging_checks(staged: DataFrame) -> DataFrame:
    """Counts of rows over a length limit or with a required value missing."""
    blank_name = F.coalesce(F.rtrim(F.col("lname")), F.lit("")) == ""
    rules: Mapping[str, Column] = {
        "lname_blank": blank_name,
        "order_dt_length": F.length(F.rtrim("order_dt")) != 10,
        "perf_dt_length": F.length(F.rtrim("perf_dt")) < 19,
    }
    return length_overflow(staged, codes.LENGTH_LIMITS).unionByName(missing_required(staged, rules))


def run_import(tables: Mapping[str, DataFrame], base: int = 100_000) -> dict[str, DataFrame]:
    """All targets of the import; the cleaned and keyed rows they share are written once.

    ``tables``: staging, quality_address, quality_email, loaded, customer,
    matchup, zone.
    """
    staged, next_id = assign_customer_no(clean_staging(tables["staging"]), base)
    staged = select_into(staged)
    mapped, unmapped = map_price_zone(staged, tables["matchup"], tables["zone"])
    return {
        "primary_customer": primary_customer_load(
            staged, tables["quality_address"], tables["quality_email"], tables["loaded"]
        ),
        "cust_keyword": legacy_keyword(staged),
        "customer": preferences(tables["customer"], staged),
        "cust_interest": interests(tables["customer"], staged),
        "ticket_history": ticket_history(mapped),
        "const_cust": constituency(staged),
        "unmapped": unmapped,
        "next_id": next_id,
        "checks": staging_checks(staged),
    }
