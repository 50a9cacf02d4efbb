"""Events without their redeliveries, as a stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statelake.schemas import BRONZE_PARTITIONS, BRONZE_SCHEMA
from statelake.sources.files import read_parquet
from statelake.streaming.latest import ROCKSDB

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def without_copies(events: DataFrame, clock: str, within: str, keys: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """A stream of events in which a key that came by the same ``clock`` within ``within`` comes once.

    The bound is what keeps the state finite: an id is forgotten once the newest clock seen is this
    much past it, while a plain deduplication would remember every id ever seen.
    """
    return events.withWatermark(clock, within).dropDuplicatesWithinWatermark(list(keys))


def stream_events(bronze: DataFrame, path: str, checkpoint: str, within: str = "1 hour", provider: str = ROCKSDB) -> StreamingQuery:
    """Append the raw rows of all events, each once, to ``path``; the file sink commits a micro-batch once.

    The clock is the time the log took the record in. Redeliveries within the bound vanish. One that
    comes later is written again, or dropped if it is itself older than the bound; ``dropped`` and
    ``late_copies`` count both. Rows without an event id or clock are no events and stay in the raw layer.
    """
    spark = bronze.sparkSession
    events = bronze.filter(F.col("event_id").isNotNull() & F.col("kafka_timestamp").isNotNull())
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, provider)
    try:
        return (
            without_copies(events, "kafka_timestamp", within)
            .writeStream.format("parquet")
            .partitionBy(*BRONZE_PARTITIONS)
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


@dataclass(frozen=True)
class Dropped:
    """Rows that a deduplicating stream left out: copies it recognised, and rows older than the bound."""

    copies: int
    too_late: int


def dropped(query: StreamingQuery) -> Dropped:
    """Over the micro-batches that the query still reports on (``spark.sql.streaming.numRecentProgressUpdates``)."""
    states = [s for p in query.recentProgress for s in p["stateOperators"]]
    copies = sum(s["customMetrics"].get("numDroppedDuplicateRows", 0) for s in states)
    return Dropped(copies, sum(s["numRowsDroppedByWatermark"] for s in states))


def late_copies(spark: SparkSession, path: str) -> DataFrame:
    """Events that came again after the bound and were written again: id, and how often too many."""
    rows = read_parquet(spark, path, BRONZE_SCHEMA, path)
    return rows.groupBy("event_id").agg((F.count("*") - 1).alias("late_copies")).filter("late_copies > 0")
