"""Date and name-derived date functions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The file-stem date pattern (four digits, then two and two,
# separated by '-' or '_') and the dated-table name shape.
FILE_DATE_PATTERN = r"(\d{4})[-_](\d{2})[-_](\d{2})"
DATED_TABLE_SUFFIX = r"(\d{4})_(\d{2})_(\d{2})"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date_literal(value) -> Column:
    """A Python date/datetime/ISO string as a DATE literal."""
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, _dt.date):
        return F.lit(value)
    return F.to_date(F.lit(str(value)))


def date_parts(date_col: Column | str, padded: bool = False) -> list[Column]:
    """``year, month, day`` partition columns from a date.

    Integers by default.  ``padded`` gives zero-padded text (``month=01``);
    either layout reads back as integers (fact F5).
    """
    d = _col(date_col)
    if padded:
        return [
            F.year(d).cast("string").alias("year"),
            F.lpad(F.month(d).cast("string"), 2, "0").alias("month"),
            F.lpad(F.dayofmonth(d).cast("string"), 2, "0").alias("day"),
        ]
    return [
        F.year(d).cast("int").alias("year"),
        F.month(d).cast("int").alias("month"),
        F.dayofmonth(d).cast("int").alias("day"),
    ]


def date_from_file_name(name: Column | str) -> Column:
    """Date found in a file stem as ``YYYY[-_]MM[-_]DD``; NULL when absent.

    One regular-expression match per value (the whole date), separators
    unified with ``translate``, then a lenient parse: no match ('') and
    impossible dates (month 13) both give NULL.
    """
    n = _col(name)
    found = F.translate(F.regexp_extract(n, FILE_DATE_PATTERN, 0), "_", "-")
    return F.try_to_date(found, "yyyy-MM-dd")


def dated_table_date(name: Column | str, prefix: str) -> Column:
    """Date of a ``<prefix>YYYY_MM_DD`` table name (X7); NULL when the name
    does not have exactly that shape (decision Z12)."""
    n = F.lower(_col(name))
    pattern = "^" + prefix.lower() + DATED_TABLE_SUFFIX + "$"
    parts = [F.nullif(F.regexp_extract(n, pattern, i), F.lit("")) for i in (1, 2, 3)]
    return F.try_make_timestamp_ntz(
        parts[0].cast("int"), parts[1].cast("int"), parts[2].cast("int"),
        F.lit(0), F.lit(0), F.lit(0),
    ).cast("date")


def parse_timestamp(c: Column | str, fmt: str | None = None) -> Column:
    """Text to timestamp without failing the job on bad values."""
    c = _col(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def iso_date(c: Column | str) -> Column:
    """``YYYY-MM-DD`` text (X11)."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def as_of_timestamp(as_of=None) -> Column:
    """The run's reference instant as UTC wall-clock ``TIMESTAMP_NTZ``.

    Injected for determinism; falls back to the query's single
    ``current_timestamp()`` converted from the session zone to UTC.
    """
    if as_of is None:
        return F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    if isinstance(as_of, _dt.datetime):
        return F.lit(as_of.replace(tzinfo=None)).cast("timestamp_ntz")
    if isinstance(as_of, _dt.date):
        return F.lit(as_of).cast("timestamp_ntz")
    return F.to_timestamp_ntz(F.lit(str(as_of)))
