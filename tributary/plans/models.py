"""Silver and gold complaint models.

Staging models take raw tables with the raw layer's odd header names and
produce the conformed complaint row; the unified model is a UNION ALL by
name; dimensions keep the latest row per key; the fact joins both
dimensions.

Scale notes
* ``latest_per_key`` is an aggregate (``max_by``), not a
  ``row_number()`` window: partial aggregation on the map side keeps one row
  per key per task, so a key holding a third of all rows never lands whole
  in one task.
* The fact joins dimensions without a broadcast hint: Catalyst broadcasts a
  dimension only when its estimated size is under
  ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-checks with the
  measured size; a large dimension falls back to a sort-merge join whose
  skewed partitions AQE splits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.casts import safe_cast
from tributary.functions.text import strip_ws
from tributary.schemas import COMPLAINT_COLUMNS


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


# --------------------------------------------------------------------------
# M1, M2: pass-through staging of reference tables
# --------------------------------------------------------------------------

def stg_passthrough(spark: SparkSession, source_table: str) -> DataFrame:
    """M1/M2: ``SELECT *`` from a declared raw source."""
    return spark.table(source_table)


def stg_agents(raw_agents: DataFrame) -> DataFrame:
    """Agents with the key under its canonical name ``agent_id``."""
    df = raw_agents
    if "id" in df.columns and "agent_id" not in df.columns:
        df = df.withColumnRenamed("id", "agent_id")
    return df


# --------------------------------------------------------------------------
# M3: channel staging -> conformed complaint rows
# --------------------------------------------------------------------------

def _conform(cols: dict[str, Column]) -> list[Column]:
    return [cols[c].alias(c) for c in COMPLAINT_COLUMNS]


# The layouts of day-first and month-name dates in text columns,
# tried after the ISO layout.
DATE_LAYOUTS = ("dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy", "dd-MM-yyyy", "d MMM yyyy")


def lenient_timestamp(c: Column) -> Column:
    """A text date or time as TIMESTAMP_NTZ: ISO, then ``DATE_LAYOUTS``; NULL for anything else."""
    return F.coalesce(safe_cast(c, "timestamp_ntz"),
                      *(F.try_to_timestamp(strip_ws(c), F.lit(layout)).cast("timestamp_ntz") for layout in DATE_LAYOUTS))


def _time(raw: DataFrame, name: str) -> Column:
    """A time column typed without failing on a bad value."""
    if isinstance(raw.schema[name].dataType, T.StringType):
        return lenient_timestamp(_q(name))
    return _q(name).try_cast("timestamp_ntz")


def stg_call_logs(raw: DataFrame) -> DataFrame:
    """M3 for call logs: odd headers renamed, text trimmed, times typed."""
    return raw.select(*_conform({
        "complaint_id": strip_ws(_q("call_id")),
        "source_system": F.lit("call_logs"),
        "customer_id": strip_ws(_q("customer_id")),
        "agent_id": strip_ws(_q("agent_id")),
        "category": strip_ws(_q("complaint_catego_ry")),
        "resolution_status": strip_ws(_q("resolutionstatus")),
        "opened_at": _time(raw, "call_start_time"),
        "closed_at": _time(raw, "call_end_time"),
        "channel": F.lit("call"),
    }))


def stg_social_media(raw: DataFrame) -> DataFrame:
    """M3 for social media: request/resolution dates arrive as text and are
    parsed without failing on bad values (Z14)."""
    return raw.select(*_conform({
        "complaint_id": strip_ws(_q("complaint_id")),
        "source_system": F.lit("social_media"),
        "customer_id": strip_ws(_q("customer_id")),
        "agent_id": strip_ws(_q("agent_id")),
        "category": strip_ws(_q("complaint_catego_ry")),
        "resolution_status": strip_ws(_q("resolutionstatus")),
        "opened_at": _time(raw, "request_date"),
        "closed_at": _time(raw, "resolution_date"),
        "channel": strip_ws(_q("media_channel")),
    }))


def stg_web_forms(raw: DataFrame) -> DataFrame:
    """M3 for web forms."""
    return raw.select(*_conform({
        "complaint_id": strip_ws(_q("form_id")),
        "source_system": F.lit("web_forms"),
        "customer_id": strip_ws(_q("customer_id")),
        "agent_id": strip_ws(_q("agent_id")),
        "category": strip_ws(_q("complaint_type")),
        "resolution_status": strip_ws(_q("resolution_status")),
        "opened_at": _time(raw, "submission_date"),
        "closed_at": F.lit(None).cast("timestamp_ntz"),
        "channel": F.lit("web"),
    }))


# --------------------------------------------------------------------------
# M4: unified complaints
# --------------------------------------------------------------------------

def int_complaints_unified(*channels: DataFrame) -> DataFrame:
    """M4: UNION ALL of conformed channel rows (same columns by name)."""
    return reduce(lambda a, b: a.unionByName(b), channels)


# --------------------------------------------------------------------------
# M5: dimensions
# --------------------------------------------------------------------------

def _orderable(dtype: T.DataType) -> bool:
    """Whether Spark compares values of the type (not maps or variants, at any depth)."""
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def latest_per_key(df: DataFrame, key: str | list[str], order_cols: list[str]) -> DataFrame:
    """M5: the row with the greatest ``order_cols`` (compared in order) per
    key — ``row_number() OVER (PARTITION BY key ORDER BY ... DESC) = 1`` —
    as a ``max_by`` aggregate with map-side partial aggregation.  Text order
    columns compare as dates (:func:`lenient_timestamp`; text that is none
    comes first, then as numbers, then in text order); rows that tie compare by all their
    columns, in their order, so the row chosen does not depend on how the data is split."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    if not order_cols:
        raise ValueError("latest_per_key needs the columns that tell which row is later")
    by = [x for c in order_cols for x in (
        [lenient_timestamp(_q(c)), safe_cast(_q(c), "double"), _q(c)] if isinstance(df.schema[c].dataType, T.StringType) else [_q(c)])]
    ties = [_q(c) if _orderable(df.schema[c].dataType) else F.to_json(F.struct(_q(c))) for c in rest if c not in order_cols]
    ordering = F.struct(*by, *ties)
    picked = df.groupBy(*[_q(k) for k in keys]).agg(
        F.max_by(F.struct(*[_q(c) for c in rest]), ordering).alias("__row")
    )
    return picked.select(*[_q(k) for k in keys], *[F.col("__row").getField(c).alias(c) for c in rest])


def dim_customers(stg_customers: DataFrame, order_cols: list[str] | None = None) -> DataFrame:
    """M5: one row per ``customer_id``; latest by ``order_cols`` (defaults to
    the extraction stamp, then the signup date, where present; neither: an error)."""
    order = order_cols or [c for c in ("_extraction_timestamp", "signup_date") if c in stg_customers.columns]
    return latest_per_key(stg_customers.where(_q("customer_id").isNotNull()), "customer_id", order)


def dim_agents(stg_agents_df: DataFrame, order_cols: list[str] | None = None) -> DataFrame:
    """M5: one row per ``agent_id``; latest by ``order_cols`` (default: the extraction
    stamp, else the years of experience; neither: an error)."""
    df = stg_agents(stg_agents_df)
    order = order_cols or [c for c in ("_extraction_timestamp", "experience") if c in df.columns][:1]
    return latest_per_key(df.where(_q("agent_id").isNotNull()), "agent_id", order)


# --------------------------------------------------------------------------
# M6: fact
# --------------------------------------------------------------------------

SPREAD = 1024      # places that rows without a key are dealt to


def left_join_spread(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join on one key whose rows without a key do not meet in one task.

    A NULL key matches nothing, but a shuffle would send all such rows to the
    same partition.  Here they carry a made-up key by a hash of the row, and a
    second join column that no row of the right side has, so they spread and
    still match nothing.  Rows of a heavy key are split by AQE's skew join."""
    spread = F.pmod(F.xxhash64(*[_q(c) for c in left.columns if _orderable(left.schema[c].dataType)]), F.lit(SPREAD))
    key_type = left.schema[left_key].dataType
    made = spread.cast("string") if isinstance(key_type, T.StringType) else spread.try_cast(key_type)
    keyed = left.withColumn("__key", F.coalesce(_q(left_key), made)).withColumn("__none", _q(left_key).isNull())
    other = right.withColumn("__has", F.lit(False))
    return keyed.join(other, (keyed["__key"] == other[right_key]) & (keyed["__none"] == other["__has"]), "left").drop("__key", "__none", "__has")


def fct_complaints(unified: DataFrame, customers_dim: DataFrame, agents_dim: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """M6: complaints with customer and agent names and resolution time; ``keep``: columns of ``unified`` to carry.

    Key ``(complaint_id, source_system)``.  Left joins keep complaints whose
    customer or agent is unknown (D2 reports those).
    """
    c = customers_dim.select(_q("customer_id").alias("__cid"), _q("name").alias("customer_name"))
    a = agents_dim.select(_q("agent_id").alias("__aid"), _q("name").alias("agent_name"))
    out = left_join_spread(left_join_spread(unified, c, "customer_id", "__cid"), a, "agent_id", "__aid")
    return out.select(
        "complaint_id", "source_system", "customer_id", "customer_name", "agent_id", "agent_name",
        "category", "resolution_status", "opened_at", "closed_at",
        F.timestamp_diff("SECOND", F.col("opened_at"), F.col("closed_at")).alias("resolution_seconds"),
        "channel", *(keep or []),
    )


# --------------------------------------------------------------------------
# materialisation
# --------------------------------------------------------------------------

def schema_name(custom: str | None, default: str) -> str:
    """A layer's custom schema name (trimmed) verbatim, else the default."""
    return default if custom is None else custom.strip()


def materialize(df: DataFrame, name: str, layer: str | None, default_schema: str = "default",
                bucket_by: str | list[str] | None = None, buckets: int | None = None) -> str:
    """Replace table ``<schema>.<name>`` with the model's rows.

    ``bucket_by``/``buckets`` save the table bucketed (and sorted) on a key:
    joins between tables bucketed the same way on that key — a fact and its
    dimension — then need no shuffle.  ``buckets`` should give files of a
    few hundred MB at the table's size.
    """
    spark = df.sparkSession
    schema = schema_name(layer, default_schema)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
    full = f"`{schema}`.`{name}`"
    writer = df.write.mode("overwrite").format("parquet")
    if bucket_by:
        keys = [bucket_by] if isinstance(bucket_by, str) else list(bucket_by)
        writer = writer.bucketBy(int(buckets or 64), *keys).sortBy(*keys)
    writer.saveAsTable(full)
    return f"{schema}.{name}"
