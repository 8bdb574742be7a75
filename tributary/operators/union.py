"""Union by name.

``unionByName(allowMissingColumns=True)`` NULL-fills missing columns, but
widening ``int`` with ``string`` promotes to BIGINT and fails at run time
under ANSI mode (fact F2).  Landing data is therefore unioned either as all
text (``as_text=True``) or after promoting each clashing column to a common
type chosen up front from the schemas.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _wider_numeric(a: T.DataType, b: T.DataType) -> T.DataType:
    """Integers widen to the larger integer; any float gives double; a
    decimal with integers stays decimal (no precision lost to double)."""
    if isinstance(a, (T.FloatType, T.DoubleType)) or isinstance(b, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        scale = max(getattr(a, "scale", 0), getattr(b, "scale", 0))
        return T.DecimalType(38, min(scale, 18))
    order = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    rank = {t: i for i, t in enumerate(order)}
    return a if rank.get(type(a), 3) >= rank.get(type(b), 3) else b


def _common_types(frames: list[DataFrame]) -> dict[str, T.DataType]:
    seen: dict[str, T.DataType] = {}
    for df in frames:
        for f in df.schema.fields:
            prev = seen.get(f.name)
            if prev is None or prev == f.dataType:
                seen[f.name] = f.dataType
            elif isinstance(prev, T.NumericType) and isinstance(f.dataType, T.NumericType):
                seen[f.name] = _wider_numeric(prev, f.dataType)
            else:
                seen[f.name] = T.StringType()
    return seen


def union_by_name(frames: list[DataFrame], as_text: bool = False) -> DataFrame:
    """UNION ALL matched by column name; a column missing from one
    input is NULL there; clashing types are promoted first (text wins).

    Inputs that are empty add no rows, so no explicit skip (U3) is needed.
    Column order follows first appearance across the inputs.
    """
    if not frames:
        raise ValueError("union_by_name needs at least one DataFrame")
    types = _common_types(frames)
    order: list[str] = []
    for df in frames:
        for c in df.columns:
            if c not in order:
                order.append(c)

    def conform(df: DataFrame) -> DataFrame:
        cols = []
        for c in order:
            target = T.StringType() if as_text else types[c]
            if c in df.columns:
                ref = F.col(f"`{c}`")
                cols.append(ref.cast(target).alias(c) if df.schema[c].dataType != target else ref)
            else:
                cols.append(F.lit(None).cast(target).alias(c))
        return df.select(*cols)

    return reduce(lambda a, b: a.unionByName(b), [conform(df) for df in frames])
