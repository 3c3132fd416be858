"""DataFrame operators: every function takes and returns DataFrames."""

from .bitmaps import counted_bitmaps, distinct_bitmaps, merged_bitmaps
from .checks import (
    invalid_pairs,
    invalid_reference,
    invalid_values,
    length_overflow,
    missing_required,
    overlapping_validity,
    profile_distinct,
    profile_many,
    reconcile_counts,
)
from .intervals import binned_date_join, elementary_pieces
from .joins import (
    by_either_key,
    dependent_left,
    effective_date_join,
    lookup_by_prefix,
    not_in_reference,
    rule_lookup,
    with_settings,
)
from .keys import surrogate_key, write_back_key
from .picks import earliest_per_key, fallback_pick, first_per_key, latest_per_key, lowest_per_key
from .tables import append_rows, conform, delete_where, select_into, update_from, update_where

__all__ = [
    "profile_many",
    "invalid_values",
    "merged_bitmaps",
    "distinct_bitmaps",
    "counted_bitmaps",
    "binned_date_join",
    "elementary_pieces",
    "append_rows",
    "by_either_key",
    "conform",
    "delete_where",
    "dependent_left",
    "earliest_per_key",
    "effective_date_join",
    "fallback_pick",
    "first_per_key",
    "invalid_pairs",
    "invalid_reference",
    "latest_per_key",
    "length_overflow",
    "lookup_by_prefix",
    "lowest_per_key",
    "missing_required",
    "not_in_reference",
    "overlapping_validity",
    "profile_distinct",
    "reconcile_counts",
    "rule_lookup",
    "select_into",
    "surrogate_key",
    "update_from",
    "update_where",
    "with_settings",
    "write_back_key",
]
