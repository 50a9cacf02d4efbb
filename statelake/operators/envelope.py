"""The JSON envelope: events to keyed log records and back, and the split of records that cannot be used."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from statelake.functions.clocks import clock, iso_naive, iso_zoned, parse_timestamp
from statelake.schemas import CORRUPT_COLUMN, EVENT_FIELDS, EVENT_SCHEMA

# Transport columns kept beside the payload, and their names in the raw layer.
TRANSPORT_COLUMNS = {
    "topic": "topic",
    "partition": "partition",
    "offset": "offset",
    "timestamp": "kafka_timestamp",
}


def stamp_event(
    events: DataFrame,
    event_time: Column | None = None,
    ingestion_time: Column | None = None,
) -> DataFrame:
    """Give lifecycle events their three clocks, as text.

    ``event_time`` of the input, the time of the source system, becomes ``original_event_time``
    without a zone. The two replay clocks carry a zone; both default to the time of the run.
    """
    return events.select(
        "event_id",
        "order_id",
        "customer_id",
        "event_type",
        iso_naive("event_time").alias("original_event_time"),
        iso_zoned(clock() if event_time is None else event_time).alias("event_time"),
        iso_zoned(clock() if ingestion_time is None else ingestion_time).alias("ingestion_time"),
        "order_status",
    )


def encode(events: DataFrame, key: str = "order_id", fields: Sequence[str] = EVENT_FIELDS, keep: Sequence[str] = ()) -> DataFrame:
    """Keyed log records: ``key`` and a JSON ``value``, both binary, plus any ``keep`` columns."""
    return events.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
        *keep,
    )


def decode(
    log: DataFrame,
    schema: StructType = EVENT_SCHEMA,
    value: str = "value",
    metadata: Mapping[str, str] = TRANSPORT_COLUMNS,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Parse the payload with a fixed schema and flatten it beside the transport columns.

    ``metadata`` maps the log's column names to their output names. With ``corrupt_column`` the text
    of a payload that is not JSON is kept there; it is NULL for every other record, so an empty
    object and a broken one can be told apart.
    """
    text = F.col(value).cast("string")
    if corrupt_column is None:
        payload = F.from_json(text, schema)
    else:
        wide = StructType(schema.fields + [StructField(corrupt_column, StringType())])
        payload = F.from_json(text, wide, {"columnNameOfCorruptRecord": corrupt_column})
    carried = [F.col(name).alias(alias) for name, alias in metadata.items()]
    # A one-row generator: later filters on the fields stay above it, so a payload is parsed once.
    return log.select(*carried, F.inline(F.array(payload))).select(*payload_names(schema, corrupt_column), *metadata.values())


def payload_names(schema: StructType, corrupt_column: str | None) -> list[str]:
    return [*schema.names, *([corrupt_column] if corrupt_column else [])]


def reject_reason(
    required: Sequence[str] = ("event_id", "order_id"),
    times: Sequence[str] = ("event_time",),
    corrupt_column: str | None = CORRUPT_COLUMN,
) -> Column:
    """Why a record cannot enter the state table, or NULL when it can.

    The first failing rule names the reason: broken JSON, then missing fields, then unreadable times.
    """
    rules: list[tuple[Column, str]] = []
    if corrupt_column:
        rules.append((F.col(corrupt_column).isNotNull(), "bad_json"))
    rules += [(F.col(name).isNull(), f"missing_{name}") for name in required]
    rules += [(F.col(name).isNull(), f"missing_{name}") for name in times]
    rules += [(parse_timestamp(name).isNull(), f"bad_{name}") for name in times]
    reason = F.lit(None).cast("string")
    for failed, label in reversed(rules):
        reason = F.when(failed, F.lit(label)).otherwise(reason)
    return reason


def split_rejects(records: DataFrame, reason: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """``(usable, rejected)``; the rejected side says why in ``reject_reason``.

    Both sides are plain filters over the same scan. Taking NULL keys out here, before any shuffle,
    is also what keeps broken records from piling up in one reduce task.
    """
    tagged = records.withColumn("reject_reason", reject_reason() if reason is None else reason)
    usable = tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return usable, tagged.filter(F.col("reject_reason").isNotNull())
