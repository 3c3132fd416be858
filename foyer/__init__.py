"""Foyer: ticketing analytics as PySpark DataFrame functions."""

from .session import tune

__all__ = ["tune"]
