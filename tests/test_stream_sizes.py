"""What a task of a streamed query takes in follows neither the size of the log nor that of its files."""

import os

import pytest
from pyspark.sql import functions as F

from statelake.registry import queries
from statelake.session import OPEN_FILES, STREAM_SPLIT_BYTES, bounded_tasks

SPLIT, FILES = "spark.sql.files.maxPartitionBytes", "spark.sql.maxConcurrentOutputFileWriters"
KINDS = ["signup", "purchase", "view", "click", "error"]


def events_table(spark, folder, count):
    """Events of seven users, one in ten minutes."""
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), (F.col("id") % 5 + 1).cast("int"))
    made = spark.range(count).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 600).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"),
        kind.alias("event_type"),
    )
    made.write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("count", [40, 400])
def test_files_of_the_log_grow_in_number_and_stay_of_a_size(spark, tmp_path, monkeypatch, count):
    monkeypatch.setattr(queries, "EVENTS_PER_FILE", 10, raising=False)
    monkeypatch.setattr(queries, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    folder, progress = events_table(spark, str(tmp_path), count), f"{tmp_path}/progress"
    log = queries._log_files(spark, folder)
    query = log.writeStream.format("parquet").option("path", f"{tmp_path}/copy").option("checkpointLocation", progress).trigger(availableNow=True).start()
    query.awaitTermination()
    copied = spark.read.parquet(f"{tmp_path}/copy")
    assert copied.count() == copied.select("offset").distinct().count() == sum(n % 3 + 1 for n in range(count))
    assert len([n for n in os.listdir(f"{progress}/commits") if n.isdigit()]) == 4
    files = spark.read.parquet(f"{tmp_path}/log").groupBy(F.input_file_name()).count().collect()
    assert len(files) == count // 10 and max(r["count"] for r in files) <= 30  # one to three records an event


@pytest.mark.parametrize(
    ("name", "starts"),
    [
        ("stream_latest_state", "stream_latest"),
        ("stream_to_bronze", "stream_bronze"),
        ("stream_to_silver", "stream_silver"),
        ("stream_events_once", "stream_events"),
    ],
)
def test_streams_run_with_bounded_tasks(spark, tmp_path, monkeypatch, name, starts):
    start, seen = getattr(queries, starts), []

    class Watched:
        def __init__(self, *args, **more):
            self.query = start(*args, **more)

        def awaitTermination(self):
            self.query.awaitTermination()
            seen.append((spark.conf.get(SPLIT, None), spark.conf.get(FILES, None)))

    monkeypatch.setattr(queries, starts, Watched)
    queries.all_queries()[name](spark, events_table(spark, str(tmp_path), 60)).collect()
    assert seen and set(seen) == {(str(STREAM_SPLIT_BYTES), str(OPEN_FILES))}
    assert spark.conf.get(SPLIT, None) is None and spark.conf.get(FILES, None) is None


def test_a_session_keeps_its_own_sizes(spark):
    spark.conf.set(SPLIT, "1m")
    try:
        with bounded_tasks(spark):
            assert spark.conf.get(SPLIT) == "1m" and spark.conf.get(FILES) == str(OPEN_FILES)
        assert spark.conf.get(SPLIT) == "1m" and spark.conf.get(FILES, None) is None
    finally:
        spark.conf.unset(SPLIT)
