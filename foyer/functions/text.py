"""Text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import codes

# A new word starts after a delimiter, but not after one that opens the text,
# and not with an "s" after an apostrophe.
_DELIMITERS = "".join("\\" + c for c in codes.WORD_DELIMITERS)
_WORD_START = rf"(?<=[{_DELIMITERS}])(?<!^[\s\S])(?!(?<=')s)"


def _upper_char(char: Column) -> Column:
    """Upper case where that is one character as well."""
    upper = F.upper(char)
    return F.when(F.length(upper) > 1, char).otherwise(upper)


def title_case(value: Column) -> Column:
    """Capitalise each word of the lower-cased text; NULL becomes the empty text.

    Texts of any length stay whole; ``length_overflow`` reports those a column is too short for.
    """
    words = F.split(F.lower(value), _WORD_START)
    raised = F.transform(
        words, lambda w: F.concat(_upper_char(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))
    )
    return F.coalesce(F.array_join(raised, ""), F.lit(""))


def lower_email(value: Column) -> Column:
    return F.lower(value)


def left_n(value: Column, n: int) -> Column:
    return F.left(value, F.lit(n))


def trimmed_length(value: Column) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(value))


def compose_message(*parts: Column | str | None) -> Column:
    """Parts joined as they are; one NULL part makes the whole message NULL."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p).cast("string") for p in parts])


def split_csv(value: Column, keep_last: bool = False) -> Column:
    """Integer array from comma-separated text.

    Only text before a comma counts, so the piece after the last comma is left
    out unless ``keep_last``. A blank piece counts as 0, a piece that is no
    integer becomes NULL.
    """
    pieces = F.split(value, ",")
    if not keep_last:
        pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    return F.transform(
        pieces,
        lambda p: F.when(F.trim(p) == "", F.lit(0)).otherwise(F.trim(p).try_cast("int")),
    )

