"""Declared schemas. Nothing in the library infers one."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Field names and types of the event payload, in payload order.
EVENT_FIELDS = [
    "event_id",
    "order_id",
    "customer_id",
    "event_type",
    "original_event_time",
    "event_time",
    "ingestion_time",
    "order_status",
]
EVENT_SCHEMA = StructType([StructField(name, StringType()) for name in EVENT_FIELDS])

# Transport columns of a log record.
LOG_SCHEMA = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
    ]
)

# Text of a payload that was not JSON; NULL for every sound record.
CORRUPT_COLUMN = "corrupt_record"

BRONZE_SCHEMA = StructType(
    EVENT_SCHEMA.fields
    + [
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("kafka_timestamp", TimestampType()),
        StructField("processing_time", TimestampType()),
        StructField("ingestion_timestamp", TimestampType()),
        StructField("lag_sec", LongType()),
        StructField(CORRUPT_COLUMN, StringType()),
        StructField("raw_date", DateType()),
        StructField("raw_hour", IntegerType()),
    ]
)
BRONZE_PARTITIONS = ["raw_date", "raw_hour"]

# Columns of the current-state table.
SILVER_SCHEMA = StructType(
    [
        StructField("order_id", StringType()),
        StructField("customer_id", StringType()),
        StructField("event_id", StringType()),
        StructField("event_type", StringType()),
        StructField("original_event_time", TimestampType()),
        StructField("event_time", TimestampType()),
        StructField("ingestion_time", TimestampType()),
        StructField("current_status", StringType()),
        StructField("ingestion_lag_sec", LongType()),
        StructField("event_date", DateType()),
        StructField("updated_at", TimestampType()),
    ]
)
# Carried by state tables that are fed increments only, to break ties on equal event times.
TIE_COLUMN = "event_offset"
SILVER_TIE_SCHEMA = StructType(SILVER_SCHEMA.fields + [StructField(TIE_COLUMN, LongType())])

# Orders by day and status, as of a commit of the state table.
COUNTS_SCHEMA = StructType(
    [
        StructField("event_date", DateType()),
        StructField("current_status", StringType()),
        StructField("orders", LongType()),
        StructField("version", LongType()),
    ]
)

# Columns of the daily summary table.
GOLD_SCHEMA = StructType(
    [
        StructField("order_date", DateType()),
        StructField("total_orders", LongType()),
        StructField("created_orders", LongType()),
        StructField("approved_orders", LongType()),
        StructField("shipped_orders", LongType()),
        StructField("delivered_orders", LongType()),
        StructField("delivery_rate", DoubleType()),
        StructField("updated_at", TimestampType()),
    ]
)

OFFSET_SCHEMA = StructType(
    [
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("next_offset", LongType()),
    ]
)

# Header of the wide order file.
ORDERS_CSV_SCHEMA = StructType(
    [
        StructField("order_id", StringType()),
        StructField("customer_id", StringType()),
        StructField("order_status", StringType()),
        StructField("order_purchase_timestamp", TimestampType()),
        StructField("order_approved_at", TimestampType()),
        StructField("order_delivered_carrier_date", TimestampType()),
        StructField("order_delivered_customer_date", TimestampType()),
        StructField("order_estimated_delivery_date", TimestampType()),
    ]
)
