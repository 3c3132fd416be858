"""Predicates and small lookups over columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import codes


def in_csv(value: Column, csv: str | None, integer: bool = True) -> Column:
    """``value`` is a member of the comma-separated ``csv``; blanks are not trimmed.

    For an integer column only tokens written exactly as the integer prints can
    match, so the test becomes an ``IN`` over integers, which the Parquet scan
    can use. Without a list nothing matches.
    """
    if csv is None:
        return F.lit(False)
    tokens = csv.split(",")
    if not integer:
        return value.isin(*tokens)
    exact = [int(t) for t in tokens if t.removeprefix("-").isdecimal() and str(int(t)) == t]
    return value.isin(*exact) if exact else F.lit(False)


def in_csv_column(value: Column, csv: Column) -> Column:
    """As :func:`in_csv` with the list in a column."""
    return F.array_contains(F.split(csv, ","), value.cast("string"))


def is_blank(value: Column) -> Column:
    return F.coalesce(F.rtrim(value), F.lit("")) == ""


def is_zero_or_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)) == 0


def text_key(value: Column) -> Column:
    """Text compared without regard to case and trailing blanks."""
    return F.lower(F.rtrim(value))


def same_text(left: Column, right: Column) -> Column:
    return text_key(left) == text_key(right)


def map_values(value: Column, fixes: Mapping[str, str | None]) -> Column:
    """Replace listed values, compared as text keys; others stay."""
    out = None
    for old, new in fixes.items():
        hit = same_text(value, F.lit(old))
        replacement = F.lit(new).cast("string")
        out = F.when(hit, replacement) if out is None else out.when(hit, replacement)
    return value if out is None else out.otherwise(value)


def email_pick(result: Column, quality: Column, original: Column) -> Column:
    """No address when the check found it dead, else the checked one, else the original."""
    dead = text_key(result).isin(*codes.DEAD_EMAIL_RESULTS)
    return F.when(dead, F.lit(None).cast("string")).otherwise(F.coalesce(quality, original))


def route_action(code: Column) -> Column:
    """Name of the module an action code leads to; NULL where there is none."""
    out = None
    for number, name in codes.ACTIONS.items():
        hit = code == number
        out = F.when(hit, name) if out is None else out.when(hit, name)
    discount = code.between(
        codes.ACTION_DISCOUNT, codes.ACTION_DISCOUNT + codes.ACTION_DISCOUNT_SPAN
    )
    gift = code.between(codes.ACTION_GIFT, codes.ACTION_GIFT + codes.ACTION_GIFT_SPAN)
    return out.when(discount, "discount_mode").when(gift, "add_contribution")
