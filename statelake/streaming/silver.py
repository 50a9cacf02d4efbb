"""The state table fed by a stream."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from statelake.plans.silver import SilverRules, refresh_silver
from statelake.sources.paths import read_text
from statelake.sources.snapshots import Batch, SnapshotTable

# Micro-batches are increments, so the state carries the offset for ties; an event that is stored
# already is skipped, which makes a log that is read again under a new checkpoint harmless.
STREAM_RULES = SilverRules(carry_tie=True, skip_unchanged=True)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint keeps over all restarts; another checkpoint has another one."""
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]


def stream_silver(
    bronze: DataFrame,
    table: SnapshotTable,
    checkpoint: str,
    rules: SilverRules = STREAM_RULES,
    as_of: dt.datetime | str | None = None,
) -> StreamingQuery:
    """Merge each micro-batch of raw rows into the state; ``table`` must have the rules' schema.

    The stream's id and the batch's number are committed with the data. A batch that Spark repeats,
    because the driver died between the commit and the checkpoint, is recognised and changes nothing,
    also under rules without a guard.
    """

    def merge_batch(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        refresh_silver(spark, batch, table, rules, as_of, batch=Batch(stream_id(spark, checkpoint), number))

    return (
        bronze.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
