"""Wide order rows to lifecycle events."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statelake.functions.identity import stable_id


class Stage(NamedTuple):
    """One lifecycle step: where its time is found and what the event is called."""

    event_type: str
    order_status: str
    time_column: str
    always: bool = False


# Event names, their statuses and the order column that dates each of them.
ORDER_STAGES = (
    Stage("ORDER_CREATED", "created", "order_purchase_timestamp", always=True),
    Stage("PAYMENT_APPROVED", "approved", "order_approved_at"),
    Stage("SHIPPED", "shipped", "order_delivered_carrier_date"),
    Stage("DELIVERED", "delivered", "order_delivered_customer_date"),
)


def cancelled_stage(time_column: str) -> Stage:
    """The optional fifth step, for sources that date a cancellation."""
    return Stage("CANCELLED", "cancelled", time_column)


def unpivot_stages(orders: DataFrame, stages: Sequence[Stage] = ORDER_STAGES, carry: Sequence[str] = ("order_id", "customer_id")) -> DataFrame:
    """Up to one event per stage and row, in one scan and no shuffle.

    A stage without a time yields no event unless it is marked ``always``. ``stage_rank`` is the
    position of the stage, for ordering events that carry the same time.
    """
    steps = [
        F.struct(
            F.lit(stage.event_type).alias("event_type"),
            F.col(stage.time_column).cast("timestamp").alias("event_time"),
            F.lit(stage.order_status).alias("order_status"),
            F.lit(rank).alias("stage_rank"),
            F.lit(stage.always).alias("always"),
        )
        for rank, stage in enumerate(stages)
    ]
    return (
        orders.select(*carry, F.inline(F.array(*steps)))
        .filter(F.col("always") | F.col("event_time").isNotNull())
        .drop("always")
    )


def lifecycle_events(
    orders: DataFrame,
    stages: Sequence[Stage] = ORDER_STAGES,
    order_id: str = "order_id",
    customer_id: str = "customer_id",
    identity: Column | None = None,
    order: str = "total",
) -> DataFrame:
    """Lifecycle events of each order, by time.

    Ids derive from order and event type, so a second run names the same events the same way. Events
    of equal time follow the lifecycle, then the order id; with those columns in the sort the range
    exchange can also split a day that holds a third of all events. ``order="partition"`` sorts
    without a shuffle, which keeps the events of each order in sequence as a keyed log needs it;
    ``order="none"`` is for a next step that shuffles anyway.
    """
    if order not in ("total", "partition", "none"):
        raise ValueError(f"unknown order: {order}")
    source = orders.select(
        F.col(order_id).alias("order_id"),
        F.col(customer_id).alias("customer_id"),
        *[F.col(c) for c in dict.fromkeys(stage.time_column for stage in stages)],
    )
    events = unpivot_stages(source, stages)
    named = events.withColumn("event_id", stable_id("order_id", "event_type") if identity is None else identity)
    sequence = [F.col("event_time").asc_nulls_last(), F.col("stage_rank"), F.col("order_id")]
    if order == "total":
        named = named.orderBy(*sequence)
    elif order == "partition":
        named = named.sortWithinPartitions(*sequence)
    return named.select("event_id", "order_id", "customer_id", "event_type", "event_time", "order_status")
