"""Cart rules on small fixtures."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from foyer.plans import cart as C
from foyer.schemas import SCHEMAS

from conftest import rows

NOW = dt.datetime(2014, 7, 9, 12)


def content(spark, *entries):
    base = {f.name: None for f in SCHEMAS["content"].fields}
    data = [tuple({**base, "id": n, **e}.values()) for n, e in enumerate(entries, 1)]
    return spark.createDataFrame(data, SCHEMAS["content"])


def config(spark, package_mos=3, *more):
    return content(
        spark,
        {"content_type": "Rules_MOS", "mos": 1},
        {"content_type": "Matinee_MOS", "mos": 4},
        {"content_type": "3_or_more_PTG", "mos": package_mos, "price_type_group": 20},
        {"content_type": "Less_than3_PTG", "price_type_group": 10},
        *more,
    )


def carts(spark, *data):
    """(order, mos, original mos, shows, keyword shows)"""
    return spark.createDataFrame(
        [(f"s{o}", o, m, g, t, k) for o, m, g, t, k in data],
        "sessionkey string, order_no long, mos int, orig_mos int, total_perfs long, total_kwd_perfs long",
    )


def state(spark, *data):
    return spark.createDataFrame(list(data), SCHEMAS["session_variable"])


def test_unknown_package_mode_keeps_carts_in_scope(spark):
    lines = spark.createDataFrame([(1, 11, 5, 1)], "order_no long, sli_no long, perf_no long, price_type int")
    pmap = spark.createDataFrame(
        [(5, 3, NOW, NOW), (5, 4, NOW, NOW)], "perf_no long, price_type int, start_dt timestamp_ntz, end_dt timestamp_ntz"
    )
    kinds = spark.createDataFrame([(1, 10), (3, 20), (4, 20)], "id int, price_type_group int")
    cart = carts(spark, (1, 9, 9, 3, 0))

    def changes(setup):
        return rows(C.reprice(cart, lines, pmap, kinds, setup, NOW))

    assert changes(config(spark, None)) == [("s1", 1, 11, 1, 3)]
    assert changes(config(spark, 3)) == []


def test_reprice_both_ways(spark):
    lines = spark.createDataFrame(
        [(1, 11, 5, 1), (1, 12, 6, 1), (2, 21, 5, 3), (3, 31, 5, 1), (4, 41, 5, 7)],
        "order_no long, sli_no long, perf_no long, price_type int",
    )
    span = (dt.datetime(2014, 1, 1), dt.datetime(2014, 12, 31))
    old = (dt.datetime(2013, 1, 1), dt.datetime(2013, 12, 31))
    pmap = spark.createDataFrame(
        [(5, 1, *span), (5, 3, *span), (5, 2, *old)],
        "perf_no long, price_type int, start_dt timestamp_ntz, end_dt timestamp_ntz",
    )
    kinds = spark.createDataFrame([(1, 10), (2, 10), (3, 20), (7, 30)], "id int, price_type_group int")
    cart = carts(spark, (1, 1, 1, 3, 0), (2, 3, 3, 2, 0), (3, 1, 4, 3, 0), (4, 1, 1, 5, 0))
    out = C.reprice(cart, lines, pmap, kinds, config(spark), NOW)
    assert rows(out) == [("s1", 1, 11, 1, 3), ("s2", 2, 21, 3, 1)]


def test_mode_of_sale_changes(spark):
    cart = carts(
        spark,
        (1, 1, 1, 3, 0),  # to package
        (2, 1, 1, 3, 0),  # changed before: stays
        (3, 3, 3, 2, 0),  # back to the mode before
        (4, 3, 3, 2, 0),  # never changed: stays
        (5, 1, 4, 3, 0),  # to matinee
        (6, 4, 4, 3, 0),  # is matinee
        (7, 9, 9, 3, 0),  # out of scope
    )
    memory = state(spark, ("s2", "MOS_Changed_From", "1"), ("s3", "mos_changed_from", "1"))
    assert rows(C.mos_change(cart, config(spark), memory)) == [("s1", 1, 3), ("s3", 3, 1), ("s5", 1, 4)]


def test_checkout_minimum(spark):
    cart = carts(
        spark, (1, 1, 1, 2, 0), (2, 1, 1, 2, 2), (3, 1, 1, 3, 0), (4, 9, 9, 1, 0), (5, 4, 4, 1, 0), (6, 1, 1, None, None)
    )
    setup = config(spark, 3, {"content_type": "Checkout_Limit_Msg", "long_text": "Three!"})
    blocked = C.checkout_blocked(cart, setup)
    assert rows(blocked.select("order_no", "message")) == [(1, "Three!"), (5, "Three!"), (6, "Three!")]
    # A matinee cart of keyword shows only: they are not counted there.
    matinee = carts(spark, (7, 1, 4, 2, 2), (8, 4, 4, 1, 1))
    assert [r["order_no"] for r in C.checkout_blocked(matinee, setup).orderBy("order_no").collect()] == [7, 8]
    assert C.checkout_blocked(matinee, setup, keywords_everywhere=True).count() == 0


def test_messages(spark):
    rules = spark.createDataFrame(
        [
            (1, 1, 0, 2, "Add one. ", "Y", "N"),
            (2, 1, 0, 3, None, None, "N"),
            (3, 1, 0, 4, "Unused", "Y", None),
        ],
        SCHEMAS["message_rule"],
    )
    cart = carts(spark, (1, 1, 1, 2, 0), (2, 1, 1, 3, 0), (3, 1, 1, 4, 0), (4, 9, 9, 2, 0))
    out = C.cart_message(cart, rules, config(spark), header="Hi. ")
    assert rows(out.select("order_no", "message", "disable_checkout")) == [
        (1, "Hi. Add one. \nContinue Shopping Click to Continue Shopping", "Y"),
        (2, "Hi. \nContinue Shopping Continue Shopping\nFinished Proceed to Checkout", "N"),
        (3, None, "N"),
    ]
    waiting = spark.createDataFrame([("s1", "N"), ("s2", "Y")], "sessionkey string, processed string")
    quiet = C.cart_message(cart, rules, config(spark), waiting)
    assert rows(quiet.select("order_no", "message"))[0] == (1, "Add one. ")


def test_gift_eligibility(spark):
    cart = carts(spark, *[(n, 1, 1, 1, 0) for n in range(1, 6)]).selectExpr("*", "order_no AS customer_no")
    setup = config(spark, 3, {"content_type": "Round_Up_Msg", "constituency": 7})
    members = spark.createDataFrame([(7, 1), (8, 2)], "constituency int, customer_no long")
    memory = state(spark, ("s2", "Gift_Asked", "1"), ("s3", "gift_asked", "2"))
    gifts = spark.createDataFrame([(4,)], "order_no long")

    def asked(given):
        return [r[0] for r in rows(C.ask_eligible(cart, given, members, memory, gifts).select("order_no"))]

    assert asked(setup) == [2, 5]
    assert asked(config(spark)) == []
    assert asked(config(spark, 3, {"content_type": "Round_Up_Msg", "inactive": "Y"})) == []


def test_gift_ask_and_codes(spark):
    cart = spark.createDataFrame([("s1", 1, Decimal("760")), ("s2", 2, Decimal("1000000"))], "sessionkey string, order_no long, order_total decimal(19,4)")
    asks = C.gift_label(C.gift_ask(cart), config(spark))
    assert rows(asks.select("order_no", "ask", "target", "label")) == [
        (1, Decimal(40), 800, "Round Up Your Order to $800"),
        (2, Decimal(10), 1000010, "Round Up Your Order to $1000010"),
    ]
    assert rows(C.round_up_state(asks))[0] == ("s1", "Round_Up", "40.00")
    actions = spark.createDataFrame(
        [("s1", 1_900_000_025), ("s1", 1_999_999_999), ("s1", 1_900_000_000), ("s1", 1_901_000_000), ("s1", 9)],
        "sessionkey string, code long",
    )
    memory = state(spark, ("s1", "ROUND_up", "2.50"))
    fund = config(spark, 3, {"content_type": "Round_Up_Msg", "value": 19})
    got = {r["code"]: r["amount"] for r in C.decode_gift(actions, memory, fund).collect()}
    assert got == {1_900_000_025: 25, 1_999_999_999: Decimal("2.5"), 1_900_000_000: None, 1_901_000_000: None}
    without = C.decode_gift(actions, memory, config(spark))
    assert {r["amount"] for r in without.collect()} == {None}


def test_preselected(spark):
    selection = spark.createDataFrame([("s1", "5,30,6,99,x"), ("s2", "7")], "sessionkey string, selection string")
    perf = spark.createDataFrame(
        [(5, 30, NOW), (6, 31, NOW), (7, 30, NOW)], "perf_no long, prod_season_no long, perf_dt timestamp_ntz"
    )
    seasons = spark.createDataFrame([(30, 3), (31, 3)], "prod_season_no long, prod_no long")
    names = spark.createDataFrame([(5, "Five"), (6, "Six"), (30, "Thirty")], "inv_no long, description string")
    orders = spark.createDataFrame([(1, "s1"), (2, "s2")], "order_no long, sessionkey string")
    lines = spark.createDataFrame([(1, 7), (1, 7), (1, 6), (2, 5)], "order_no long, perf_no long")
    then = spark.createDataFrame([(1, 6)], "order_no long, perf_no long")
    items = C.preselected(selection, perf, seasons, names, orders, then)
    label = "Five - Wednesday, 9 July, 2014 12:00pm"
    columns = ("pds_no", "perf_no", "label", "processed")
    assert rows(items.select(*columns)) == [(30, None, "Thirty", "N"), (30, 5, label, "N")]
    marked = C.mark_processed(items, orders, lines, perf)
    assert rows(marked.select(*columns)) == [(30, None, "Thirty", "Y"), (30, 5, label, "N")]


def test_selection_texts_have_defaults(spark):
    setup = content(spark, {"content_type": "Pre_Selected_Perfs", "long_text": "Pick"})
    out = C.selection_texts(setup, carts(spark, (1, 2, 2, 0, 0)).select("order_no", "mos"), NOW)
    assert rows(out) == [(1, 2, "  Select  ", "Pick", "I don't wish to make any further selections.")]


def test_content_for_a_mode_and_a_date(spark):
    def entry(**more):
        return {"content_type": "Pre_Selected_Perfs", **more}

    setup = content(
        spark,
        entry(long_text="off", inactive="Y"),
        entry(long_text="past", thru_dt=dt.datetime(2014, 7, 8)),
        entry(long_text="two", mos=2, thru_dt=dt.datetime(2014, 7, 9)),
        entry(long_text="any"),
        entry(long_text="late", mos=3),
    )
    cart = carts(spark, (1, 2, 2, 0, 0), (2, 3, 3, 0, 0), (3, None, 0, 0, 0)).select("order_no", "mos")
    at = lambda hour: C.active_content(setup, cart, "pre_selected_perfs", dt.datetime(2014, 7, 9, hour), ["long_text"])
    assert rows(at(12).select("order_no", "long_text")) == [(1, "two"), (2, "any"), (3, "any")]


def test_last_line_and_counts(spark):
    lines = spark.createDataFrame(
        [(1, 1, 9, None, 3), (1, 2, 4, 1, 1), (1, 2, 5, 2, 2), (2, None, 7, None, 1)],
        "order_no long, li_seq_no int, perf_no long, pkg_no int, price_type int",
    )
    assert rows(C.last_line_item(lines)) == [(1, 2, 5, 2, 2, 2), (2, 0, 7, None, 1, 1)]
    cart_lines = spark.createDataFrame([(1, 5), (1, 5), (1, 6), (2, None)], "order_no long, perf_no long")
    marked = spark.createDataFrame([(6,), (7,)], "perf_no long")
    assert rows(C.perf_counts(cart_lines, marked)) == [(1, 2, 1)]


def test_default_login_is_not_logged_in(spark):
    memory = state(spark, ("a", "username", "ANON"), ("b", "UserName", "me"), ("c", "Other", "anon"))
    defaults = spark.createDataFrame([("anon",)], "default_login string")
    assert rows(C.logged_in(memory, defaults)) == [("a", "N"), ("b", "Y")]


def test_two_settings_of_one_type_stop_the_query(spark):
    twice = config(spark, 3, {"content_type": "rules_mos", "mos": 8})
    with pytest.raises(Exception, match="SCALAR_SUBQUERY"):
        C.checkout_blocked(carts(spark, (1, 1, 1, 1, 0)), twice).collect()
