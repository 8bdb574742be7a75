"""JSON and nested-record functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.casts import safe_cast


def json_field(c: Column | str, path: str, data_type: str = "string") -> Column:
    """One field of a JSON text column, cast without failing on bad values
    (X15).  ``path`` is a JSONPath such as ``$.k``."""
    c = F.col(c) if isinstance(c, str) else c
    return safe_cast(F.get_json_object(c, path), data_type)


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Flatten nested structs to top-level columns named ``a.b.c``.

    Arrays and maps are kept as they are, like a record normaliser that only
    walks objects.  A pure projection: no job, no shuffle.
    """

    def walk(dtype: T.DataType, path: list[str]) -> list[Column]:
        if isinstance(dtype, T.StructType):
            out: list[Column] = []
            for f in dtype.fields:
                out.extend(walk(f.dataType, path + [f.name]))
            return out
        ref = F.col(path[0]) if len(path) == 1 else _nested(path)
        return [ref.alias(sep.join(path))]

    cols: list[Column] = []
    for f in df.schema.fields:
        cols.extend(walk(f.dataType, [f.name]))
    return df.select(*cols)


def _nested(path: list[str]) -> Column:
    c = F.col(f"`{path[0]}`")
    for p in path[1:]:
        c = c.getField(p)
    return c


def to_json_text(c: Column | str) -> Column:
    """Serialise a struct/array/map/variant column to JSON text."""
    return F.to_json(F.col(c) if isinstance(c, str) else c)
