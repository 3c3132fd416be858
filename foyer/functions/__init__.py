"""Column functions: every one is a built-in expression, none is a Python UDF."""

from .dates import (
    add_hours,
    between_open,
    month_of,
    padded_dmy,
    parse_dmy,
    parse_dmy_time,
    pretty_datetime,
    short_datetime,
    snapshot_dt,
    year_of,
)
from .money import ask_level, extended_amount, gift_target, money, round_up_ask
from .predicates import (
    email_pick,
    in_csv,
    in_csv_column,
    is_blank,
    is_zero_or_null,
    map_values,
    route_action,
    same_text,
    text_key,
)
from .text import compose_message, left_n, lower_email, split_csv, title_case, trimmed_length

__all__ = [
    "add_hours",
    "ask_level",
    "between_open",
    "compose_message",
    "email_pick",
    "extended_amount",
    "gift_target",
    "in_csv",
    "in_csv_column",
    "is_blank",
    "is_zero_or_null",
    "left_n",
    "lower_email",
    "map_values",
    "money",
    "month_of",
    "padded_dmy",
    "parse_dmy",
    "parse_dmy_time",
    "pretty_datetime",
    "round_up_ask",
    "route_action",
    "same_text",
    "short_datetime",
    "snapshot_dt",
    "split_csv",
    "text_key",
    "title_case",
    "trimmed_length",
    "year_of",
]
