"""The raw layer as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from statelake.plans.ingest import to_bronze
from statelake.schemas import BRONZE_PARTITIONS


def stream_bronze(log: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take in all that the log holds now and stop; the checkpoint remembers where.

    Same projection as the batch job. The file sink commits each micro-batch once, so a restarted
    stream neither loses nor repeats records.
    """
    return (
        to_bronze(log)
        .writeStream.format("parquet")
        .partitionBy(*BRONZE_PARTITIONS)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
