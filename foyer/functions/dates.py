"""Dates and times. All moments are without time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import codes
from .text import trimmed_length

Moment = dt.datetime | dt.date | str


def moment(value: Moment | Column | None) -> Column:
    """A literal moment without time zone."""
    if isinstance(value, Column):
        return value
    text = value.isoformat(" ") if isinstance(value, dt.datetime) else value
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        text = value.isoformat()
    return F.lit(text).cast("timestamp_ntz")


def between_open(value: Column, low: Moment | None, high: Moment | None) -> Column:
    """Inclusive range; a missing end falls back to the widest date the data allows."""
    return value.between(
        moment(codes.RANGE_MIN if low is None else low),
        moment(codes.RANGE_MAX if high is None else high),
    )


def padded_dmy(value: Column, with_time: bool = False) -> Column:
    """Put back a leading zero the export dropped from ``dd/mm/yyyy[ hh:mm:ss]``."""
    length = trimmed_length(value)
    short = length < 19 if with_time else length == 9
    return F.when(short, F.concat(F.lit("0"), value)).otherwise(value)


def _iso_day(value: Column) -> Column:
    return F.concat(
        F.substring(value, 7, 4), F.lit("-"), F.substring(value, 4, 2), F.lit("-"),
        F.substring(value, 1, 2),
    )


def parse_dmy(value: Column) -> Column:
    """Day from ``dd/mm/yyyy`` text; NULL where it is not a date."""
    return _iso_day(padded_dmy(value)).try_cast("date")


def parse_dmy_time(value: Column) -> Column:
    """Moment from ``dd/mm/yyyy hh:mm:ss`` text; NULL where it is not one."""
    padded = padded_dmy(value, with_time=True)
    return F.concat(_iso_day(padded), F.lit(" "), F.substring(padded, 12, 8)).try_cast(
        "timestamp_ntz"
    )


def _clock(value: Column, am: str, pm: str) -> Column:
    """`` 7:30pm``: the hour on a twelve-hour clock takes two places."""
    hour = F.hour(value)
    return F.concat(
        F.lpad(((hour + 11) % 12 + 1).cast("string"), 2, " "),
        F.lit(":"),
        F.lpad(F.minute(value).cast("string"), 2, "0"),
        F.when(hour < 12, am).otherwise(pm),
    )


def pretty_datetime(value: Column) -> Column:
    """``Wednesday, 9 July, 2014  7:30pm``."""
    day = F.date_format(value.cast("date"), "EEEE, d MMMM, yyyy")
    return F.concat(day, F.lit(" "), _clock(value, "am", "pm"))


def short_datetime(value: Column) -> Column:
    """``Jul  9 2014  7:30PM``: day and hour take two places each."""
    day = value.cast("date")
    return F.concat(
        F.date_format(day, "MMM"),
        F.lit(" "),
        F.lpad(F.dayofmonth(day).cast("string"), 2, " "),
        F.lit(" "),
        F.date_format(day, "yyyy"),
        F.lit(" "),
        _clock(value, "AM", "PM"),
    )


def add_hours(value: Column, hours: int) -> Column:
    return value + F.expr(f"interval {int(hours)} hours")


def snapshot_dt(end: Moment | Column | None, as_of: Moment) -> Column:
    """The moment the sales are valid for: never later than ``as_of``."""
    last = moment(end)
    now = moment(as_of)
    return F.when(last.cast("date") >= now.cast("date"), now).otherwise(last)


def month_of(value: Column) -> Column:
    return F.month(value)


def year_of(value: Column) -> Column:
    return F.year(value)
