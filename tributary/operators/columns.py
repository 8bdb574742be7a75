"""Header and value cleaning, projections.

Header cleaning is metadata work on ``df.columns`` followed by one
projection; it never starts a job.  Value cleaning is one ``select`` of
built-in expressions.
"""

from __future__ import annotations

import re
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.casts import safe_cast
from tributary.functions.text import clean_email, strip_ws

# Fixed value: characters the full clean removes after the light clean.
_NOT_NAME_CHAR = re.compile(r"[^a-z0-9_]")


def clean_name_light(name: str) -> str:
    """Lower-case, strip surrounding whitespace, spaces become ``_``."""
    return name.lower().strip().replace(" ", "_")


def clean_name_full(name: str) -> str:
    """The light clean, then drop every character outside ``[a-z0-9_]``."""
    return _NOT_NAME_CHAR.sub("", clean_name_light(name))


class HeaderCollisionError(ValueError):
    """Two source headers clean to the same name (fact F8)."""


def cleaned_names(names: list[str], mode: str = "light") -> list[str]:
    fn = {"light": clean_name_light, "full": clean_name_full}[mode]
    out = [fn(n) for n in names]
    groups: dict[str, list[str]] = defaultdict(list)
    for src, dst in zip(names, out):
        groups[dst.lower()].append(src)
    clashes = {k: v for k, v in groups.items() if len(v) > 1}
    if clashes:
        detail = "; ".join(f"{v} -> {k!r}" for k, v in sorted(clashes.items()))
        raise HeaderCollisionError(f"headers collide after cleaning: {detail}")
    return out


def clean_headers(df: DataFrame, mode: str = "light") -> DataFrame:
    """Rename every column with the light (P1) or full (P2) clean.

    Collisions (``A b`` and ``a_b``, or names equal ignoring case) are
    reported up front instead of failing at write time.
    """
    new = cleaned_names(df.columns, mode)
    if new == df.columns:
        return df
    return df.select(*[F.col(f"`{o}`").alias(n) for o, n in zip(df.columns, new)])


def strip_string_columns(df: DataFrame) -> DataFrame:
    """Strip surrounding whitespace from every string column; others pass."""
    cols: list[Column] = []
    for f in df.schema.fields:
        ref = F.col(f"`{f.name}`")
        cols.append(strip_ws(ref).alias(f.name) if isinstance(f.dataType, T.StringType) else ref)
    return df.select(*cols)


def clean_sheet(df: DataFrame) -> DataFrame:
    """Drop rows where every column is NULL, full header clean, strip
    every string column.  NULL values stay NULL (decision Z1)."""
    return strip_string_columns(clean_headers(df.na.drop(how="all"), mode="full"))


def clean_email_column(df: DataFrame, column: str) -> DataFrame:
    """Lower-case and strip one column; a no-op when it is absent."""
    if column not in df.columns:
        return df
    return df.withColumn(column, clean_email(F.col(f"`{column}`")))


def read_projection(
    df: DataFrame,
    columns: list[str] | None = None,
    where: str | Column | None = None,
    limit: int | None = None,
    order_by: list[str] | None = None,
) -> DataFrame:
    """P5-P7 and L3 on any relation: projection, predicate text, limit.

    With a Parquet or JDBC relation the projection and predicate reach the
    scan (``ReadSchema`` / ``PushedFilters``).  A limit without an order is
    nondeterministic, so ``order_by`` is offered beside it.
    """
    out = df
    if where is not None:
        out = out.where(where)
    if columns:
        out = out.select(*[F.col(f"`{c}`") for c in columns])
    if order_by:
        out = out.orderBy(*order_by)
    if limit is not None:
        out = out.limit(int(limit))
    return out


def add_pandas_index_names(names: list[str]) -> list[str]:
    """Name blank headers ``Unnamed: <pos>`` and de-duplicate repeats as
    ``name.1``, ``name.2`` — how a CSV header row is conventionally named
    by dataframe libraries.  The light clean then turns ``Unnamed: 0`` into
    ``unnamed:_0``.
    """
    out: list[str] = []
    seen: dict[str, int] = {}
    for i, n in enumerate(names):
        n = n if n.strip() != "" else f"Unnamed: {i}"
        if n in seen:
            seen[n] += 1
            n = f"{n}.{seen[n]}"
        else:
            seen[n] = 0
        out.append(n)
    return out


# File extensions the landing layer accepts.
SUPPORTED_EXTENSIONS = (".csv", ".json")


def extension_of(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return ("." + name.rsplit(".", 1)[-1]).lower() if "." in name else ""


def dispatch_by_extension(paths: list[str]) -> dict[str, list[str]]:
    """Split paths into ``csv``, ``json`` and ``skipped`` (P12).  Extension
    matching ignores case (``D.CSV`` is a CSV)."""
    out: dict[str, list[str]] = {"csv": [], "json": [], "skipped": []}
    for p in paths:
        ext = extension_of(p)
        if ext == ".csv":
            out["csv"].append(p)
        elif ext == ".json":
            out["json"].append(p)
        else:
            out["skipped"].append(p)
    return out


def project_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto ``schema`` by case-insensitive column name: missing
    columns become NULL, extra columns are dropped, differing types are
    ``try_cast`` (a value that does not fit becomes NULL, the job goes on).
    """
    by_lower = {c.lower(): c for c in df.columns}
    cols: list[Column] = []
    for f in schema.fields:
        src = by_lower.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif df.schema[src].dataType == f.dataType:
            cols.append(F.col(f"`{src}`").alias(f.name))
        else:
            text = isinstance(df.schema[src].dataType, T.StringType)
            cols.append(safe_cast(F.col(f"`{src}`"), f.dataType, source_is_text=text).alias(f.name))
    return df.select(*cols)
