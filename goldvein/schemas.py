"""Declared schemas of the four bronze event streams.

Bronze keeps the event fields as they arrive (timestamps stay ISO strings) and
adds three lineage columns at ingest. A fixed schema replaces type inference,
so an all-NULL batch or a new field cannot change a column's type.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L = T.StringType(), T.DoubleType(), T.LongType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


LINEAGE_FIELDS = (("kinesis_sequence_number", S), ("kinesis_partition_key", S), ("processed_at", S))

CUSTOMER_EVENT = _struct(
    ("event_id", S), ("event_type", S), ("timestamp", S), ("customer_id", S), ("action", S),
    ("email", S), ("country", S), ("device_type", S), ("session_id", S), ("ip_address", S),
    ("user_agent", S),
)
TRANSACTION_EVENT = _struct(
    ("event_id", S), ("event_type", S), ("timestamp", S), ("transaction_id", S), ("customer_id", S),
    ("amount", D), ("currency", S), ("status", S), ("payment_method", S), ("merchant_id", S),
    ("category", S), ("fraud_score", D),
)
PRODUCT_EVENT = _struct(
    ("event_id", S), ("event_type", S), ("timestamp", S), ("product_id", S), ("customer_id", S),
    ("action", S), ("category", S), ("price", D), ("quantity", L), ("rating", D), ("session_id", S),
)
SYSTEM_LOG = _struct(
    ("event_id", S), ("event_type", S), ("timestamp", S), ("service", S), ("level", S),
    ("message", S), ("request_id", S), ("response_time_ms", L), ("status_code", L),
    ("endpoint", S), ("user_id", S),
)

# stream name -> (bronze table name, payload schema)
STREAMS = {
    "customer-events": ("bronze_customer_events", CUSTOMER_EVENT),
    "transaction-events": ("bronze_transaction_events", TRANSACTION_EVENT),
    "product-events": ("bronze_product_events", PRODUCT_EVENT),
    "system-logs": ("bronze_system_logs", SYSTEM_LOG),
}

BRONZE_TABLES = tuple(t for t, _ in STREAMS.values())


def bronze_table_name(stream_name: str) -> str:
    return "bronze_" + stream_name.replace("-", "_")


def with_lineage(payload: T.StructType) -> T.StructType:
    return T.StructType(list(payload.fields) + [T.StructField(n, t, True) for n, t in LINEAGE_FIELDS])


BRONZE_SCHEMAS = {bronze_table_name(s): with_lineage(p) for s, (_, p) in STREAMS.items()}

# Envelope of one stream record, as landed in files: partition key, sequence
# number and the JSON payload text.
ENVELOPE = _struct(("partition_key", S), ("sequence_number", S), ("data", S))
