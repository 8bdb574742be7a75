"""Declared raw-layer table schemas and the layer databases.

Raw tables are text-heavy on purpose (values land as they come; staging
casts).  Timestamps are wall-clock values from the source systems, so they
are ``TIMESTAMP_NTZ``.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType
TS = T.TimestampNTZType


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t(), True) for n, t in fields])


# Table names and column lists of the raw layer.
AGENTS = _struct(("id", S), ("name", S), ("experience", S), ("state", S))

CUSTOMERS = _struct(
    ("customer_id", S), ("name", S), ("gender", S), ("date_of_birth", S),
    ("signup_date", S), ("email", S), ("address", S),
)

CALL_LOGS = _struct(
    ("unnamed:_0", S), ("call_id", S), ("customer_id", S), ("complaint_catego_ry", S),
    ("agent_id", S), ("call_start_time", TS), ("call_end_time", TS),
    ("resolutionstatus", S), ("calllogsgenerationdate", TS),
)

SOCIAL_MEDIA = _struct(
    ("complaint_id", S), ("customer_id", S), ("complaint_catego_ry", S), ("agent_id", S),
    ("resolutionstatus", S), ("request_date", S), ("resolution_date", S),
    ("media_channel", S), ("mediacomplaintgenerationdate", S),
)

WEB_FORMS = T.StructType([
    T.StructField("form_id", S(), True),
    T.StructField("customer_id", S(), True),
    T.StructField("agent_id", S(), True),
    T.StructField("complaint_type", S(), True),
    T.StructField("resolution_status", S(), True),
    T.StructField("submission_date", TS(), True),
    T.StructField("year", T.IntegerType(), True),
    T.StructField("month", T.IntegerType(), True),
    T.StructField("day", T.IntegerType(), True),
    T.StructField("_extraction_timestamp", TS(), True),
    T.StructField("_source_system", S(), True),
    T.StructField("_source_location", S(), True),
    T.StructField("_row_count", T.LongType(), True),
])

RAW_TABLES: dict[str, T.StructType] = {
    "agents": AGENTS,
    "customers": CUSTOMERS,
    "call_logs": CALL_LOGS,
    "social_media": SOCIAL_MEDIA,
    "web_forms": WEB_FORMS,
}

# Layer databases (raw -> silver -> gold).
LAYERS = ("raw", "silver", "gold")

# The resolution states the declared tests accept.
RESOLUTION_STATES = ("Resolved", "Pending", "Escalated")

# Conformed complaint row shared by every channel (M4).
COMPLAINT_COLUMNS = (
    "complaint_id", "source_system", "customer_id", "agent_id", "category",
    "resolution_status", "opened_at", "closed_at", "channel",
)

# Fixed values: ``_source_system`` stamped by each extractor.
SOURCE_SYSTEMS = {
    "customers": "s3_customers",
    "call_logs": "s3_call_logs",
    "social_media": "s3_social_media",
    "agents": "google_sheets_agents",
    "web_forms": "postgres_web_forms",
}
