"""Keyed session state, in batch and on streams."""

from .runner import event_stream, fold_stream
from .state import (
    add_totals,
    apply_changes,
    ask_count,
    ask_flag,
    ask_totals,
    first_rows,
    last_rows,
    set_once,
    state_changes,
    state_latest,
)

__all__ = [
    "add_totals",
    "apply_changes",
    "ask_count",
    "ask_flag",
    "ask_totals",
    "event_stream",
    "first_rows",
    "fold_stream",
    "last_rows",
    "set_once",
    "state_changes",
    "state_latest",
]
