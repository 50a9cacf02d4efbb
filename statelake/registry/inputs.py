"""The test tables read as an order-event log, and as wide orders.

``events`` stands in for the log: a user's day is an order, an event's hour is its (coarse) event
time, so that ties occur and have to be broken. Every event is delivered one to three times, each
redelivery ten minutes after the one before. All of this is derived by Spark from the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from statelake.functions.clocks import iso_naive, iso_zoned
from statelake.operators.envelope import encode
from statelake.plans.ingest import to_bronze
from statelake.session import fit_session

TOPIC = "order-events"
PROCESSED_AT = "2024-02-01 00:00:00"
# event type of the table -> (event type, order status) of an order's life
KINDS = {
    "signup": ("ORDER_CREATED", "created"),
    "purchase": ("PAYMENT_APPROVED", "approved"),
    "view": ("SHIPPED", "shipped"),
    "click": ("DELIVERED", "delivered"),
    "error": ("CANCELLED", "cancelled"),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}.parquet"
    fit_session(spark, path)
    return spark.read.parquet(path)


def plain(df: DataFrame) -> DataFrame:
    """Instants as zone-less timestamps, the form the SQL side returns."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def _renamed(position: int) -> Column:
    result = F.lit(None).cast("string")
    for kind, names in KINDS.items():
        result = F.when(F.col("event_type") == kind, names[position]).otherwise(result)
    return result


def single_events(spark: SparkSession, folder: str) -> DataFrame:
    """One typed row per event, with its place in the log."""
    ts = F.col("ts").cast("timestamp")
    return table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        _renamed(0).alias("event_type"),
        ts.alias("original_event_time"),
        F.date_trunc("hour", ts).alias("event_time"),
        (ts + F.make_dt_interval(secs=F.col("event_id") % 90)).alias("ingestion_time"),
        _renamed(1).alias("order_status"),
        F.lit(TOPIC).alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        (F.col("event_id") * 3).alias("offset"),
        F.col("event_id").alias("number"),
    )


def deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """Typed events including their redeliveries, as the raw layer would hold them after typing."""
    attempts = F.sequence(F.lit(0), (F.col("number") % 3).cast("int"))
    return (
        single_events(spark, folder)
        .withColumn("attempt", F.explode(attempts))
        .withColumn("ingestion_time", F.col("ingestion_time") + F.make_dt_interval(mins=F.col("attempt") * 10))
        .withColumn("offset", F.col("offset") + F.col("attempt"))
        .withColumn("lag_sec", F.unix_timestamp(F.lit(PROCESSED_AT).cast("timestamp")) - F.unix_timestamp("ingestion_time"))
        .drop("attempt")
    )


def moved_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """``deliveries`` in which later copies of every seventh event name another order."""
    moved = (F.col("number") % 7 == 0) & (F.col("offset") % 3 > 0)
    return deliveries(spark, folder).withColumn("order_id", F.when(moved, F.concat("order_id", F.lit("-m"))).otherwise(F.col("order_id")))


def as_text(events: DataFrame) -> DataFrame:
    """The payload form: all times as ISO text."""
    return events.withColumns(
        {
            "original_event_time": iso_naive("original_event_time"),
            "event_time": iso_zoned("event_time"),
            "ingestion_time": iso_zoned("ingestion_time"),
        }
    )


def log(spark: SparkSession, folder: str, slices: int | None = None) -> DataFrame:
    """The deliveries as keyed JSON records of a log; with ``slices`` in so many ranges of offsets.

    The ranges are dealt out before the records are encoded, which the sampling for them would do once more.
    """
    events = deliveries(spark, folder).withColumn("timestamp", F.col("ingestion_time"))
    if slices:
        events = events.repartitionByRange(slices, "offset")
    return encode(as_text(events), keep=("topic", "partition", "offset", "timestamp"))


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    return to_bronze(log(spark, folder), PROCESSED_AT)


def wide_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with lifecycle times: approval a day after purchase where the status says so, shipping
    and delivery from the order's first and last line."""
    lines = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    )
    status = F.col("o_orderstatus")
    return (
        table(spark, folder, "orders")
        .join(lines, "o_orderkey", "left")
        .select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            status.alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            F.when(status.isin("P", "F"), F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("order_approved_at"),
            F.col("first_ship").alias("order_delivered_carrier_date"),
            F.when(status == "F", F.col("last_ship")).alias("order_delivered_customer_date"),
            F.when(status == "O", F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS")).alias("order_cancelled_at"),
        )
    )
