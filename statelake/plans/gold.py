"""State to one summary row per day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statelake.functions.clocks import clock
from statelake.operators.merge import and_changed
from statelake.operators.summary import STATUS_COLUMNS, apply_changes, daily_summary, summary_of_counts
from statelake.schemas import COUNTS_SCHEMA, GOLD_SCHEMA
from statelake.session import sized
from statelake.sources.snapshots import MAX_PARTITIONS, SnapshotTable, upsert
from statelake.sources.tables import merge_into, read_table


def daily_order_summary(
    state: DataFrame,
    as_of: dt.datetime | str | Column | None = None,
    wanted: Mapping[str, str] = STATUS_COLUMNS,
    with_other: bool = False,
) -> DataFrame:
    """The summary rows of all days in ``state``, stamped."""
    return daily_summary(state, wanted=wanted, with_other=with_other).withColumn("updated_at", clock(as_of))


def gold_table(path: str, partition_by: str | None = None) -> SnapshotTable:
    """The summary table. It holds one row per day, so by default it is not split into a file per day."""
    return SnapshotTable(path, GOLD_SCHEMA, partition_by)


def refresh_gold(
    spark: SparkSession,
    silver: SnapshotTable,
    gold: SnapshotTable,
    days: Collection[object] | None = None,
    as_of: dt.datetime | str | Column | None = None,
    wanted: Mapping[str, str] = STATUS_COLUMNS,
    prune_missing: bool = False,
) -> bool:
    """Recompute summary rows and merge them; returns whether the table changed.

    ``days``, as returned by ``refresh_silver``, limits the scan to those partitions of the state. Days
    that earlier refreshes of the state noted and no summary has taken in yet always join them, so a
    run that died between the two tables is made good by the next. The notes are dropped once the
    summary is committed. A day whose orders have all moved on keeps its old row unless
    ``prune_missing``.
    """
    notes, noted = silver.noted_changes(spark)
    if days is not None:
        days = None if noted is None else set(days) | noted
    with sized(spark, paths=(silver.root, gold.root)):
        state = silver.read(spark, partitions=days)
        summary = daily_order_summary(state, as_of, wanted).select(*GOLD_SCHEMA.names)
        doomed = None
        if prune_missing:
            doomed = set(days) if days is not None else _stored_days(spark, gold)
        columns = [c for c in GOLD_SCHEMA.names if c != "order_date"]
        changed = upsert(
            gold, summary, ["order_date"], None, columns,
            delete_missing_in=doomed, delete_column="order_date", unique_source=True,
        )
    silver.drop_notes(spark, notes)
    return bool(changed)


# What the state table has to count changes by for ``refresh_gold_by_changes``.
COUNTED_BY = ("event_date", "current_status")


def counts_table(path: str) -> SnapshotTable:
    """Orders by day and status; a few thousand rows, replaced whole."""
    return SnapshotTable(path, COUNTS_SCHEMA)


def refresh_counts(spark: SparkSession, silver: SnapshotTable, counts: SnapshotTable) -> bool:
    """Bring ``counts`` up to the last commit of ``silver``; returns whether rows of the state were counted.

    Normally the commits since the last refresh are taken in by what each wrote about its changes, in
    one commit of ``counts`` that also holds the number of the last commit taken in. So a run that dies
    and is repeated, before or after that commit, takes every change in exactly once. The state itself
    is counted the first time, and when a commit is found that wrote no changes.
    """
    version = silver.version(spark)
    known = counts.read(spark)
    applied = known.agg(F.max("version")).first()[0]
    if applied == version:
        return False
    changes = None if applied is None or applied > version else silver.count_changes_since(spark, applied)
    with sized(spark, paths=(silver.root,) if changes is None else (counts.root,)):
        if changes is None:
            fresh = silver.read(spark).groupBy(*COUNTED_BY).agg(F.count("*").alias("orders"))
        else:
            fresh = apply_changes(known, changes, COUNTED_BY)
        counts.replace(fresh.withColumn("version", F.lit(version).cast("long")))
    silver.drop_count_changes(spark, version)
    return changes is None


def refresh_gold_by_changes(
    spark: SparkSession,
    silver: SnapshotTable,
    counts: SnapshotTable,
    gold: SnapshotTable,
    as_of: dt.datetime | str | Column | None = None,
    wanted: Mapping[str, str] = STATUS_COLUMNS,
    prune_missing: bool = False,
) -> bool:
    """As ``refresh_gold``, without reading the state: its cost is that of the changes.

    The summary of all days follows from ``counts``; days whose numbers are stored already stay as they
    are, which also makes good a run that died between the two tables. ``silver`` has to be a table with
    ``count_by=COUNTED_BY``.
    """
    if tuple(silver.count_by) != COUNTED_BY:
        raise ValueError(f"the state table has to count its changes by {COUNTED_BY}")
    notes, _ = silver.noted_changes(spark)
    refresh_counts(spark, silver, counts)
    summary = summary_of_counts(counts.read(spark), wanted=wanted).withColumn("updated_at", clock(as_of)).select(*GOLD_SCHEMA.names)
    numbers = [c for c in GOLD_SCHEMA.names if c not in ("order_date", "updated_at")]
    stored, days = _stored_days(spark, gold), _stored_days(spark, summary)
    doomed = stored - days if prune_missing else set()
    doomed |= stored & days & {None}  # a row without a day matches none, so the old one goes
    changed = upsert(
        gold, summary, ["order_date"], and_changed(numbers, "TRUE"), [*numbers, "updated_at"],
        delete_missing_in=doomed, delete_column="order_date", unique_source=True,
    )
    silver.drop_notes(spark, notes)
    return bool(changed)


def _stored_days(spark: SparkSession, gold: SnapshotTable | DataFrame) -> set[object]:
    summary = gold.read(spark) if isinstance(gold, SnapshotTable) else gold
    rows = summary.select("order_date").limit(MAX_PARTITIONS + 1).collect()
    if len(rows) > MAX_PARTITIONS:
        raise ValueError(f"the summary holds more than {MAX_PARTITIONS} days; name the days to refresh")
    return {row["order_date"] for row in rows}


def merge_gold_table(
    spark: SparkSession,
    silver: str,
    gold: str,
    as_of: dt.datetime | str | Column | None = None,
    prune_missing: bool = False,
) -> None:
    """The summary of one catalog table merged into another whose provider carries out ``MERGE``."""
    summary = daily_order_summary(read_table(spark, silver), as_of).select(*GOLD_SCHEMA.names)
    merge_into(gold, summary, ["order_date"], delete_missing=prune_missing)
