"""Explicit schemas: nothing in this package infers a type from data.

Keys and counts are 64-bit: at cluster scale neither fits 32 bits.
"""

from __future__ import annotations

from pyspark.sql import types as T

INT = T.IntegerType()
LONG = T.LongType()
TEXT = T.StringType()
MONEY = T.DecimalType(19, 4)
#: Sums of money: one performance may hold more rows than fit its own type.
TOTAL = T.DecimalType(38, 4)
MOMENT = T.TimestampNTZType()


def table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


SCHEMAS: dict[str, T.StructType] = {
    # import
    "staging": table(
        legacy_no=LONG, prefix=TEXT, fname=TEXT, lname=TEXT, street1=TEXT, street2=TEXT, city=TEXT,
        state=TEXT, pcode=TEXT, country=TEXT, phone1=TEXT, phone2=TEXT, email=TEXT,
        presenter_email_DNM=TEXT, email_address_decline=TEXT, perf_name=TEXT, perf_dt=TEXT,
        no_tix=INT, price_type=TEXT, zone=TEXT, location=TEXT, tix_amt=MONEY, source_code=TEXT,
        mos_category=TEXT, order_dt=TEXT,
    ),
    "primary_customer": table(
        customer_no=LONG, prefix=TEXT, fname=TEXT, lname=TEXT, street1=TEXT, street2=TEXT,
        city=TEXT, state=TEXT, postal_code=TEXT, country=TEXT, phone1=TEXT, phone2=TEXT,
        eaddress=TEXT, original_source_no=INT, ref_id=LONG,
    ),
    "ticket_history": table(
        role=INT, perf_no=INT, perf_dt=MOMENT, order_dt=T.DateType(), customer_no=LONG, mos=INT,
        tck_amt=MONEY, price_type=INT, perf_name=TEXT, num_seats=INT, type=TEXT, season=INT,
        location=TEXT, pkg_no=INT, zone_no=INT, comp_code=INT, order_no=INT, theater_no=INT,
    ),
    "cust_keyword": table(keyword_no=INT, customer_no=LONG, key_value=TEXT),
    "cust_interest": table(customer_no=LONG, tkw=INT, selected=TEXT),
    "const_cust": table(constituency=INT, customer_no=LONG),
    # cart configuration and state
    "content_type": table(id=INT, content_type=TEXT, description=TEXT),
    "content": table(
        id=INT, content_type=TEXT, mos=INT, constituency=INT, price_type_group=INT, value=INT,
        from_dt=MOMENT, thru_dt=MOMENT, button_text=TEXT, short_text=TEXT, long_text=TEXT,
        inactive=TEXT,
    ),
    "message_rule": table(
        id=INT, keyword=INT, num_perfs_kwd=INT, num_perfs_total=INT, message_text=TEXT,
        disable_checkout=TEXT, inactive=TEXT,
    ),
    "session_variable": table(sessionkey=TEXT, name=TEXT, value=TEXT),
    "changed_prices": table(sessionkey=TEXT, sli_no=LONG, orig_pricetype=INT),
    "preselected_perfs": table(
        sessionkey=TEXT, pd_no=LONG, pds_no=LONG, perf_no=LONG, pds_desc=TEXT, perf_dt=MOMENT,
        processed=TEXT,
    ),
    # report
    "perf_selection": table(
        perf_no=LONG, perf_dt=MOMENT, perf_code=TEXT, perf_desc=TEXT, prod_season_no=LONG
    ),
    "sales": table(
        sale_ind=TEXT, perf_no=LONG, no_seats_sold=LONG, no_seats_reserved=LONG, no_comps=LONG,
        price_type=INT, zone_no=LONG, nett=TOTAL, gst=TOTAL,
    ),
    "report": table(
        perf_no=LONG, perf_code=TEXT, perf_dt=MOMENT, perf_desc=TEXT, DR_tix_count=LONG,
        DR_tix_value=TOTAL, TD_tix_count=LONG, TD_tix_value=TOTAL, TD_GST_value=TOTAL,
        TD_comp_count=LONG, TD_consig_count=LONG, TD_unpaid_count=LONG, TD_holds=LONG,
        TD_available=LONG, TD_capacity=LONG, sales_snapshot_dt=MOMENT,
    ),
}
