"""Raw layer to one current row per order."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statelake.functions.clocks import clock, parse_columns, seconds_between
from statelake.operators.envelope import reject_reason, split_rejects
from statelake.operators.latest import dedup_newest, drop_copies, latest_by, rows_of_changed_keys
from statelake.operators.merge import and_changed, not_older, not_older_then
from statelake.schemas import SILVER_SCHEMA, SILVER_TIE_SCHEMA, TIE_COLUMN
from statelake.session import materialized, sized
from statelake.sources.snapshots import Batch, SnapshotTable, upsert
from statelake.sources.tables import merge_into

TIME_COLUMNS = ["original_event_time", "event_time", "ingestion_time"]


@dataclass(frozen=True)
class SilverRules:
    """The points on which state jobs differ.

    ``copies``
        What happens to copies of an event: ``"newest"`` keeps the last one to come in, ``"any"`` an
        arbitrary one, ``"fold"`` leaves them to the latest-row selection. Folding saves the shuffle
        of the whole log on the event id. It gives the same state as ``"newest"`` provided that the
        copies of an event agree on order and event time, and come in in offset order, which holds
        for redeliveries within one log partition.
    ``order``
        Which event is the latest, most significant column first, descending.
    ``status``
        The column that becomes ``current_status``.
    ``lag``
        ``"processing"`` takes the raw layer's processing minus ingestion time; ``"ingestion"`` is
        ingestion minus event time.
    ``guarded``
        Whether an older event may not overwrite stored state.
    ``skip_unchanged``
        Whether a row is left alone when its stored event is the same one.
    ``carry_tie``
        Whether the state keeps the event's offset, so that increments can be merged without
        reading history again.
    """

    copies: str = "newest"
    order: tuple[str, ...] = ("event_time", "offset", "event_id")
    copy_order: tuple[str, ...] = ("ingestion_time", "offset")
    status: str = "event_type"
    lag: str = "processing"
    guarded: bool = True
    skip_unchanged: bool = False
    carry_tie: bool = False

    @property
    def guard(self) -> str | None:
        guard = None
        if self.guarded:
            guard = not_older_then("event_time", TIE_COLUMN) if self.carry_tie else not_older("event_time")
        if self.skip_unchanged:
            identity = ["event_id", TIE_COLUMN] if self.carry_tie else ["event_id"]
            guard = and_changed(identity, guard or "TRUE")
        return guard

    def __post_init__(self) -> None:
        if self.carry_tie and self.order[:2] != ("event_time", "offset"):
            raise ValueError("the carried tie is the offset, so events have to be ordered by event time and offset")

    @property
    def rejects(self) -> Column:
        """Why a record cannot be used: its times have to be readable where the rules look at them."""
        times = ["event_time"]
        if self.lag == "ingestion" or "ingestion_time" in self.order:
            times.append("ingestion_time")
        return reject_reason(times=times)

    @property
    def schema(self):
        return SILVER_TIE_SCHEMA if self.carry_tie else SILVER_SCHEMA


# Ties by log offset, status from the event type, older events refused.
OFFSET_RULES = SilverRules()
# Ties by ingestion time, status from the order status, last merge wins.
INGESTION_RULES = SilverRules(
    order=("event_time", "ingestion_time", "offset", "event_id"),
    status="order_status",
    lag="ingestion",
    guarded=False,
)


def prepare_silver(bronze: DataFrame, copy_order: Sequence[str] = ("ingestion_time", "offset")) -> DataFrame:
    """All events, typed, one row per event id, with their date and ingestion lag.

    Records without an event id are no events; ``rejected_records`` lists them.
    """
    named = bronze.filter(F.col("event_id").isNotNull())
    typed = parse_columns(named, ["event_time", "ingestion_time"])
    deduped = dedup_newest(typed, ["event_id"], copy_order)
    return deduped.withColumn("event_date", F.to_date("event_time")).withColumn(
        "ingestion_lag_sec", seconds_between("ingestion_time", "event_time")
    )


def latest_events(events: DataFrame, rules: SilverRules = OFFSET_RULES) -> DataFrame:
    """The newest event of each order; ``events`` has typed times and no NULL keys."""
    if rules.copies == "newest":
        events = dedup_newest(events, ["event_id"], rules.copy_order)
    elif rules.copies == "any":
        events = drop_copies(events, ["event_id"])
    elif rules.copies != "fold":
        raise ValueError(f"unknown treatment of copies: {rules.copies}")
    return latest_by(events, ["order_id"], rules.order)


def to_state_rows(
    latest: DataFrame, rules: SilverRules = OFFSET_RULES, as_of: dt.datetime | str | Column | None = None
) -> DataFrame:
    """Project events to the columns of the state table."""
    if rules.lag == "processing":
        lag = F.col("lag_sec").cast("long")
    elif rules.lag == "ingestion":
        lag = seconds_between("ingestion_time", "event_time")
    else:
        raise ValueError(f"unknown lag: {rules.lag}")
    tie = [F.col("offset").alias(TIE_COLUMN)] if rules.carry_tie else []
    return latest.select(
        "order_id",
        "customer_id",
        "event_id",
        "event_type",
        *TIME_COLUMNS,
        F.col(rules.status).alias("current_status"),
        lag.alias("ingestion_lag_sec"),
        F.to_date("event_time").alias("event_date"),
        clock(as_of).alias("updated_at"),
        *tie,
    )


def current_state(
    bronze: DataFrame, rules: SilverRules = OFFSET_RULES, as_of: dt.datetime | str | Column | None = None
) -> DataFrame:
    """Current state of each order in ``bronze``.

    Times are parsed before they are compared, so mixed zones and fraction lengths order correctly.
    Records without an event or order id belong to no order and are left out.
    """
    typed = parse_columns(bronze.filter("event_id IS NOT NULL AND order_id IS NOT NULL"), TIME_COLUMNS)
    return to_state_rows(latest_events(typed, rules), rules, as_of)


def silver_table(path: str, rules: SilverRules = OFFSET_RULES, count_by: tuple[str, ...] = ()) -> SnapshotTable:
    """The state table; with ``count_by`` it also writes how each upsert changes the counts of these groups."""
    return SnapshotTable(path, rules.schema, "event_date", key="order_id", count_by=count_by)


def refresh_silver(
    spark: SparkSession,
    bronze: DataFrame,
    table: SnapshotTable,
    rules: SilverRules = OFFSET_RULES,
    as_of: dt.datetime | str | Column | None = None,
    history: DataFrame | None = None,
    batch: Batch | None = None,
) -> list[object]:
    """Merge the state of ``bronze`` into ``table``; returns the days whose rows changed.

    Records without ids or with unreadable times the rules need are left out. When ``bronze`` is only
    an increment, either pass the whole raw layer, increment included, as ``history`` to rank the
    changed orders over all their events, or use rules with ``carry_tie``. The changed days are noted
    beside the table before it is committed, until a summary has taken them in. ``batch`` names the
    micro-batch that ``bronze`` is; one that the table has taken in already changes nothing.
    """
    columns = [c for c in rules.schema.names if c != "order_id"]
    with sized(spark, bronze, *([] if history is None else [history]), paths=(table.root,)):
        with _state_of(bronze, rules, as_of, history) as source:
            return upsert(
                table, source, ["order_id"], rules.guard, columns, unique_source=True, note_changes=True, batch=batch
            )


def refresh_state(spark: SparkSession, state: DataFrame, table: SnapshotTable, rules: SilverRules) -> list[object]:
    """Merge state rows, one per order, into ``table``; returns the days whose rows changed."""
    columns = [c for c in rules.schema.names if c != "order_id"]
    with sized(spark, state, paths=(table.root,)):
        return upsert(table, state, ["order_id"], rules.guard, columns, unique_source=True, note_changes=True)


def usable_records(bronze: DataFrame, rules: SilverRules) -> DataFrame:
    return split_rejects(bronze, rules.rejects)[0]


@contextmanager
def _state_of(
    bronze: DataFrame, rules: SilverRules, as_of: dt.datetime | str | Column | None, history: DataFrame | None
) -> Iterator[DataFrame]:
    """State rows of an increment: of its own events, or of all events in ``history`` it may concern."""
    usable = usable_records(bronze, rules)
    if history is None:
        yield to_state_rows(latest_events(parse_columns(usable, TIME_COLUMNS), rules), rules, as_of)
        return
    typed = parse_columns(usable_records(history, rules), TIME_COLUMNS)
    with materialized(changed_orders(typed, usable), "orders") as orders:
        yield to_state_rows(latest_of_changed(typed, orders, rules), rules, as_of)


def changed_orders(history: DataFrame, increment: DataFrame) -> DataFrame:
    """The orders an increment may change: its own, and those that any copy of its events names.

    A later copy of an event can name another order; the order it named before then loses it.
    """
    ids = increment.select("event_id").distinct()
    named = history.join(ids, "event_id", "left_semi").select("order_id")
    return named.unionByName(increment.select("order_id")).distinct()


def latest_of_changed(history: DataFrame, orders: DataFrame, rules: SilverRules) -> DataFrame:
    """The newest events of ``orders``, one row each, as a ranking of the whole raw layer gives them.

    All copies of every event that any copy places in one of the orders are deduplicated before the
    orders are picked. Whether the ids travel by broadcast or by shuffle is up to Spark and their
    measured size; the steps and their result are the same.
    """
    if rules.copies == "fold":
        return latest_events(rows_of_changed_keys(history, orders, ["order_id"]), rules)
    events = rows_of_changed_keys(history, orders, ["order_id"]).select("event_id")
    copies = rows_of_changed_keys(history, events, ["event_id"])
    single = dedup_newest(copies, ["event_id"], rules.copy_order) if rules.copies == "newest" else drop_copies(copies, ["event_id"])
    return latest_by(rows_of_changed_keys(single, orders, ["order_id"]), ["order_id"], rules.order)


def merge_silver_table(
    bronze: DataFrame,
    table: str,
    rules: SilverRules = OFFSET_RULES,
    as_of: dt.datetime | str | Column | None = None,
    history: DataFrame | None = None,
) -> None:
    """The same into a catalog table whose provider carries out ``MERGE``."""
    with sized(bronze.sparkSession, bronze, *([] if history is None else [history])):
        with _state_of(bronze, rules, as_of, history) as source:
            merge_into(table, source, ["order_id"], guard=rules.guard)


def rejected_records(bronze: DataFrame, rules: SilverRules = OFFSET_RULES) -> DataFrame:
    """Raw rows that ``refresh_silver`` leaves out, each with its reason."""
    return split_rejects(bronze, rules.rejects)[1]
