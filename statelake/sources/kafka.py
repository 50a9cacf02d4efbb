"""The Kafka connector of Spark, used when its jar is on the classpath. Everything downstream takes any
DataFrame of the same shape, so it is the only module that names the connector."""

from __future__ import annotations

import json
from collections.abc import Collection, Mapping
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession

from statelake.operators.offsets import MAX_BROADCAST_POSITIONS

EARLIEST = "earliest"
# Fixed value: how the connector writes a partition's earliest position.
FROM_EARLIEST = -2


def topic_partitions(spark: SparkSession, servers: str, topic: str, options: Mapping[str, str] = MappingProxyType({})) -> list[int]:
    """The partitions a topic has now, from the admin client that comes with the connector's jars."""
    jvm = spark.sparkContext._jvm
    settings = jvm.java.util.Properties()
    settings.put("bootstrap.servers", servers)
    for name, value in options.items():
        if name.startswith("kafka."):
            settings.put(name.removeprefix("kafka."), value)
    client = jvm.org.apache.kafka.clients.admin.AdminClient.create(settings)
    try:
        found = client.describeTopics(jvm.java.util.Collections.singletonList(topic)).allTopicNames().get().get(topic)
        return sorted(p.partition() for p in found.partitions())
    finally:
        client.close()


def starting_offsets(positions: DataFrame | None, topic: str, partitions: Collection[int] = ()) -> str:
    """Positions as the connector's JSON, or ``earliest`` when there are none.

    A batch read accepts only positions that name every partition of the topic. Those of
    ``partitions`` that no position is stored for (silent so far, or new) start at their earliest
    record. One row per log partition comes to the driver.
    """
    if positions is None:
        return EARLIEST
    rows = positions.filter(positions["topic"] == topic).limit(MAX_BROADCAST_POSITIONS + 1).collect()
    if len(rows) > MAX_BROADCAST_POSITIONS:
        raise ValueError(f"more than {MAX_BROADCAST_POSITIONS} partitions for topic {topic}")
    if not rows:
        return EARLIEST
    starts = {int(p): FROM_EARLIEST for p in partitions} | {r["partition"]: r["next_offset"] for r in rows}
    return json.dumps({topic: {str(p): starts[p] for p in sorted(starts)}})


def read_slice(
    spark: SparkSession, servers: str, topic: str, positions: DataFrame | None = None, options: Mapping[str, str] = MappingProxyType({})
) -> DataFrame:
    """The bounded slice from the stored positions up to the end of the log as it is now.

    ``options`` are the connector's own: security, ``minPartitions``, ``failOnDataLoss`` and so on.
    """
    start = starting_offsets(positions, topic)
    if start != EARLIEST:
        start = starting_offsets(positions, topic, topic_partitions(spark, servers, topic, options))
    return (
        spark.read.format("kafka")
        .options(**options)
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
        .option("endingOffsets", "latest")
        .load()
    )


def read_stream(spark: SparkSession, servers: str, topic: str, options: Mapping[str, str] = MappingProxyType({})) -> DataFrame:
    """The same topic as a stream; positions live in the checkpoint."""
    return (
        spark.readStream.format("kafka")
        .options(**options)
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", EARLIEST)
        .load()
    )


def write_log(records: DataFrame, servers: str, topic: str, options: Mapping[str, str] = MappingProxyType({})) -> None:
    """Send ``key``/``value`` records; the key decides the partition, so an order stays in one."""
    records.write.format("kafka").options(**options).option("kafka.bootstrap.servers", servers).option("topic", topic).save()
