"""Latest state of each order held by the stream itself.

The newest event of every order is a streaming aggregate in Spark's state store, so a micro-batch
meets only the orders it holds, by key, and never a scan of the state table. What changed in a batch
is written under its number; reading takes the newest of these, and from time to time they are
merged into the state table, at one scan for many batches.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statelake.functions.clocks import parse_columns
from statelake.operators.latest import latest_by
from statelake.plans.silver import TIME_COLUMNS, SilverRules, refresh_state, to_state_rows, usable_records
from statelake.sources.paths import child_names, delete
from statelake.sources.snapshots import SnapshotTable

# The state grows with the number of orders, so it belongs on disk and not on the heap.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_WIDTH = "spark.sql.shuffle.partitions"
LATEST_RULES = SilverRules(copies="fold", carry_tie=True, skip_unchanged=True)
_BATCH = "__batch"


def newest(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``latest_by`` as an aggregate, which a stream can keep; tasks send one row per key and batch.

    Order columns compare with NULL as the smallest, as a descending order with NULLs last has it.
    """
    rest = [c for c in events.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("newest")
    return events.groupBy(*keys).agg(best).select(*keys, "newest.*").select(*events.columns)


def stream_latest(
    bronze: DataFrame,
    path: str,
    checkpoint: str,
    rules: SilverRules = LATEST_RULES,
    as_of: dt.datetime | str | Column | None = None,
    provider: str = ROCKSDB,
    width: int | None = None,
) -> StreamingQuery:
    """Keep the newest event of every order; write the state rows that each micro-batch changed.

    Copies are folded: they have to agree on order and event time and come in in offset order (see
    ``SilverRules``). A repeated batch overwrites what it wrote. ``width`` is the number of state
    partitions; the first run fixes it for the life of the checkpoint, so size it to the orders to come.
    """
    if rules.copies != "fold" or not rules.carry_tie:
        raise ValueError("a stream keeps one row per order: rules need copies='fold' and carry_tie")
    spark = bronze.sparkSession
    events = parse_columns(usable_records(bronze, rules), TIME_COLUMNS)
    kept = newest(events, ["order_id"], rules.order)

    def write_batch(batch: DataFrame, number: int) -> None:
        to_state_rows(batch, rules, as_of).write.mode("overwrite").parquet(f"{path}/batch={number:010d}")

    before = {key: spark.conf.get(key, None) for key in (_PROVIDER, _WIDTH)}
    spark.conf.set(_PROVIDER, provider)
    if width:
        spark.conf.set(_WIDTH, str(width))
    try:  # a query keeps the settings it was started under
        return (
            kept.writeStream.outputMode("update")
            .foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _batches(spark: SparkSession, path: str) -> list[str]:
    names = child_names(spark, path)
    return [n for n in names if n.startswith("batch=") and "_SUCCESS" in child_names(spark, f"{path}/{n}")]


def changed_state(spark: SparkSession, path: str, rules: SilverRules = LATEST_RULES, batches: Sequence[str] | None = None) -> DataFrame:
    """The newest state row of every order that any batch (or any of ``batches``) under ``path`` changed."""
    names = _batches(spark, path) if batches is None else batches
    if not names:
        return spark.createDataFrame([], rules.schema)
    paths = [f"{path}/{n}" for n in names]
    rows = spark.read.schema(rules.schema).parquet(*paths)
    number = F.regexp_extract(F.col("_metadata.file_path"), "/batch=([0-9]+)/", 1)
    return latest_by(rows.select("*", number.alias(_BATCH)), ["order_id"], [_BATCH]).drop(_BATCH)


def merge_changed_state(spark: SparkSession, path: str, table: SnapshotTable, rules: SilverRules = LATEST_RULES) -> list[object]:
    """Merge all written batches into the state table, then drop them; returns the days that changed.

    A run that dies before it dropped them merges them again, which changes nothing: stored events are
    skipped and older ones refused.
    """
    if not (rules.guarded and rules.skip_unchanged):
        raise ValueError("batches may be merged again, so the rules have to refuse older and skip stored events")
    names = _batches(spark, path)
    days = refresh_state(spark, changed_state(spark, path, rules, names), table, rules) if names else []
    for name in names:
        delete(spark, f"{path}/{name}")
    return days
