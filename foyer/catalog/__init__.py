"""Registered queries over the given tables, and their SQL."""

from . import basics, cart, importer, report  # noqa: F401  (registers the queries)
from .registry import ENTRIES, spark_query

__all__ = ["ENTRIES", "spark_query"]
