"""Number parsing for all-text package files.

Whole numbers, nearly all values, take the short way of a cast; the pattern is evaluated
only for the rest.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal notation. A bare cast would also take Java suffixes such as `25d`.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def lenient_double(text: Column) -> Column:
    """Text -> double, null where the text is not a number."""
    return F.when(text.rlike(_NUMBER), text.cast("double"))


def truncated_int(text: Column) -> Column:
    """Text -> bigint without its fraction, null where the text is not a number."""
    return F.coalesce(text.try_cast("bigint"), lenient_double(text).cast("bigint"))


def lenient_int(text: Column) -> Column:
    """Text -> int, null where the text is not a number; a fraction is an error."""
    number = lenient_double(text)
    message = F.concat(F.lit("not a whole number: "), text)
    whole = F.when(number != F.floor(number), F.raise_error(message).cast("int")).otherwise(number.cast("int"))
    return F.coalesce(text.try_cast("int"), whole)


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))
