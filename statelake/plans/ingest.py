"""Log to raw layer."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from statelake.functions.clocks import clock, parse_timestamp, seconds_between
from statelake.operators.envelope import decode
from statelake.operators.offsets import advance_offsets, next_offsets, resume
from statelake.schemas import BRONZE_SCHEMA, CORRUPT_COLUMN, OFFSET_SCHEMA
from statelake.sources.files import append_parquet, read_parquet
from statelake.sources.kafka import read_slice
from statelake.sources.snapshots import SnapshotTable


def stamp_landing(records: DataFrame, as_of: dt.datetime | str | Column | None = None) -> DataFrame:
    """Add the processing clock, the landing partition and the processing lag."""
    return (
        records.withColumn("processing_time", clock(as_of))
        .withColumn("ingestion_timestamp", parse_timestamp("ingestion_time"))
        .withColumn("lag_sec", seconds_between("processing_time", "ingestion_timestamp"))
        .withColumn("raw_date", F.to_date("processing_time"))
        .withColumn("raw_hour", F.hour("processing_time"))
    )


def to_bronze(log: DataFrame, as_of: dt.datetime | str | Column | None = None) -> DataFrame:
    """Log records to raw rows: one projection, no shuffle, every record kept."""
    decoded = decode(log, corrupt_column=CORRUPT_COLUMN)
    return stamp_landing(decoded, as_of).select(*BRONZE_SCHEMA.names)


def offset_table(path: str) -> SnapshotTable:
    """Stored log positions."""
    return SnapshotTable(path, OFFSET_SCHEMA)


@dataclass(frozen=True)
class IngestResult:
    """What one ingest run did; ``written`` is false when the log had nothing new."""

    written: bool
    as_of: dt.datetime | None = None


def ingest_bronze(
    spark: SparkSession,
    log: DataFrame,
    bronze_path: str,
    offsets_path: str,
    as_of: dt.datetime | None = None,
    resumed: bool = False,
) -> IngestResult:
    """Append what is new in ``log`` to the raw layer and advance the stored positions.

    ``resumed`` says that ``log`` already starts at the stored positions, as a Kafka slice does. The log
    is read once: the rows are counted as they are written. The run's clock is fixed once, and the positions are read back from what was written under it. So
    they are right even if the log grew meanwhile or lost tasks read it twice, and nothing has to be
    cached. A crash between the two steps repeats records but loses none; deduplication on the event
    id takes the repeats out.
    """
    stamp = as_of or dt.datetime.now(dt.timezone.utc)
    positions = offset_table(offsets_path)
    stored = positions.read(spark)
    fresh = log if resumed else resume(log, stored)
    seen = Observation()
    append_parquet(to_bronze(fresh, stamp).observe(seen, F.count(F.lit(1)).alias("records")), bronze_path)
    if not seen.get["records"]:
        return IngestResult(False)

    landed = read_parquet(spark, bronze_path, BRONZE_SCHEMA, bronze_path).filter(
        (F.col("raw_date") == F.to_date(clock(stamp))) & (F.col("raw_hour") == F.hour(clock(stamp)))
    )
    positions.replace(advance_offsets(stored, next_offsets(landed)))
    return IngestResult(True, stamp)


def ingest_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    bronze_path: str,
    offsets_path: str,
    as_of: dt.datetime | None = None,
    options: Mapping[str, str] = MappingProxyType({}),
) -> IngestResult:
    """``ingest_bronze`` over a topic: the stored positions go to the connector, which reads no older record."""
    stored = offset_table(offsets_path).read(spark)
    return ingest_bronze(spark, read_slice(spark, servers, topic, stored, options), bronze_path, offsets_path, as_of, resumed=True)
