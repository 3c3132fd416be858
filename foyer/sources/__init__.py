"""Sources and sinks."""

from .loading import Loaded, TooManyErrors, load_staging
from .staging import read_staging, write_staging
from .stored import Changes, StoredTable
from .tables import append_table, load, save_table

__all__ = ["Changes", "Loaded", "StoredTable", "TooManyErrors", "append_table", "load", "load_staging", "read_staging", "save_table", "write_staging"]
