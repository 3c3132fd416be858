"""Money arithmetic, exact: decimals in, whole cents inside."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import codes


def money(value: Column) -> Column:
    return value.cast("decimal(19,4)")


def extended_amount(quantity: Column, amount: Column) -> Column:
    return money(quantity * money(amount))


def ask_level(total: Column) -> Column:
    """Step the gift ask rounds to, by cart total."""
    out = None
    for below, level in codes.ASK_LEVELS:
        hit = total < below
        out = F.when(hit, F.lit(level)) if out is None else out.when(hit, F.lit(level))
    return out.otherwise(F.lit(codes.ASK_LEVEL_ABOVE))


def _div(left: Column, right: Column | int) -> Column:
    """Whole-number division."""
    return F.call_function("div", left, F.lit(right) if isinstance(right, int) else right)


def _ask_cents(total: Column) -> Column:
    """Gift that takes the total, raised by 2 %, down to a multiple of its level."""
    cents = (money(total) * 100).cast("long")
    level = ask_level(total).cast("long")
    raised = _div(cents + _div(cents * 2, 100), 100)
    raw = _div(raised, level) * level * 100 - cents
    ask = (
        F.when(raw < _div(level, 3) * 100, raw + level * 100)
        .when(raw > level * 100, level * 100)
        .when(raw == 0, F.lit(100).cast("long"))
        .otherwise(raw)
    )
    whole_cents = (money(total) * 100) == cents
    return F.when((total >= 0) & whole_cents, ask)


def round_up_ask(total: Column) -> Column:
    """Gift that rounds the cart up; NULL for negative totals and parts of a cent."""
    return money(_ask_cents(total).cast("decimal(20,0)") / 100)


def gift_target(total: Column) -> Column:
    """Cart total with the gift, rounded to whole currency units."""
    return F.round(money(total) + round_up_ask(total), 0).cast("long")
