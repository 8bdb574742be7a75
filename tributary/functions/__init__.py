"""Scalar column functions: text, dates, JSON."""

from tributary.functions.dates import (
    as_of_timestamp,
    date_from_file_name,
    date_parts,
    dated_table_date,
    iso_date,
    parse_timestamp,
)
from tributary.functions.jsonfn import flatten, json_field, to_json_text
from tributary.functions.text import (
    bytes_to_mb,
    clean_email,
    default_if_null,
    path_predicate,
    strip_ws,
    to_text,
)

__all__ = [
    "as_of_timestamp", "date_from_file_name", "date_parts", "dated_table_date", "iso_date",
    "parse_timestamp", "flatten", "json_field", "to_json_text", "bytes_to_mb", "clean_email",
    "default_if_null", "path_predicate", "strip_ws", "to_text",
]
