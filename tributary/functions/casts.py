"""Text-to-type casts that stay cheap on bad values (used by X5, D5, K11).

``try_cast`` of a string that is not a number (or date, or boolean) costs
far more per value than a valid one.  A type check over a text column
full of bad values would pay that on every row.  ``safe_cast`` first tests
a loose condition that every castable value meets (a number holds a digit of
some script, or nan / inf; a boolean is one of its words) and only hands
those values to ``try_cast``; the rest are NULL at regex cost.  The result
equals ``try_cast`` (property-tested) with one exception: text that is only a
time of day (``10:30``, ``T10:30``) is NULL as a timestamp.  ``try_cast`` would
put today's date before it, so a re-run on another day would load other
values; a date or timestamp must start with a year.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Conditions a value must meet before a cast is attempted.  Edges
# may carry any character that the cast trims (control characters and space).
_EDGE = r"[\x00-\x20\x7f]*"
NUMBER_SHAPE = "^" + _EDGE + r"[+-]?(?:\p{Nd}|\.|(?i:nan|inf))"
BOOLEAN_SHAPE = "^" + _EDGE + r"(?i:t|true|y|yes|1|f|false|n|no|0)" + _EDGE + "$"
DATETIME_SHAPE = "^" + _EDGE + r"[+-]?[0-9]{4}"


def _shape_for(dtype: T.DataType) -> str | None:
    if isinstance(dtype, T.NumericType):
        return NUMBER_SHAPE
    if isinstance(dtype, T.BooleanType):
        return BOOLEAN_SHAPE
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return DATETIME_SHAPE
    return None


def _as_type(dtype: T.DataType | str) -> T.DataType:
    return T.DataType.fromDDL(dtype) if isinstance(dtype, str) else dtype


def safe_cast(c: Column | str, dtype: T.DataType | str, source_is_text: bool = True) -> Column:
    """``try_cast(c AS dtype)`` that skips the cast for values that cannot
    be of that type, and gives NULL for a time without a date.  Only text
    sources get the pre-check."""
    c = F.col(c) if isinstance(c, str) else c
    target = _as_type(dtype)
    shape = _shape_for(target) if source_is_text else None
    if shape is None:
        return c.try_cast(target)
    return F.when(c.rlike(shape), c.try_cast(target))

