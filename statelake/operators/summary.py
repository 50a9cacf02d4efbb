"""Daily aggregates of the state table and of order-level facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statelake.functions.counters import other_count, safe_ratio, status_counts

# Summary columns and the status each of them counts.
STATUS_COLUMNS = {
    "created_orders": "ORDER_CREATED",
    "approved_orders": "PAYMENT_APPROVED",
    "shipped_orders": "SHIPPED",
    "delivered_orders": "DELIVERED",
}


def daily_summary(
    state: DataFrame,
    date: str = "event_date",
    status: str = "current_status",
    wanted: Mapping[str, str] = STATUS_COLUMNS,
    part: str = "delivered_orders",
    with_other: bool = False,
) -> DataFrame:
    """Orders per day in total and by status, and the delivered share.

    Rows are counted within each map task first, so what is shuffled is days, not orders.
    """
    counts = [F.count("*").alias("total_orders"), *status_counts(status, wanted)]
    if with_other:
        counts.append(other_count(status, wanted, "other_orders"))
    daily = state.groupBy(F.col(date).alias("order_date")).agg(*counts)
    return daily.withColumn("delivery_rate", safe_ratio(part, "total_orders"))


def count_changes(changed: DataFrame, removed: DataFrame | None, by: Sequence[str]) -> DataFrame:
    """What a change does to the row counts per ``by``: ``(*by, change)`` where the change is not zero.

    ``changed`` has the new values, ``__updated``, and the old ones of updated rows as ``__old_<name>``;
    ``removed`` are rows that go. Each task adds up its own rows first.
    """
    one = F.lit(1).cast("long")
    images = changed.select(*by, one.alias("change")).unionByName(
        changed.filter("__updated").select(*[F.col(f"__old_{c}").alias(c) for c in by], (-one).alias("change"))
    )
    if removed is not None:
        images = images.unionByName(removed.select(*by, (-one).alias("change")))
    return images.groupBy(*by).agg(F.sum("change").alias("change")).filter("change <> 0")


def apply_changes(counts: DataFrame, changes: DataFrame, by: Sequence[str], count: str = "orders") -> DataFrame:
    """``counts`` with all ``changes`` added; groups that end at zero are gone, one below zero is an error."""
    both = counts.select(*by, count).unionByName(changes.select(*by, F.col("change").alias(count)))
    summed = both.groupBy(*by).agg(F.sum(count).alias(count))
    broken = F.raise_error(F.lit(f"changes take more rows away than were counted by {tuple(by)}"))
    return summed.filter(F.when(F.col(count) < 0, broken.cast("boolean")).otherwise(F.col(count) > 0))


def summary_of_counts(
    counts: DataFrame,
    date: str = "event_date",
    status: str = "current_status",
    count: str = "orders",
    wanted: Mapping[str, str] = STATUS_COLUMNS,
    part: str = "delivered_orders",
    with_other: bool = False,
) -> DataFrame:
    """``daily_summary`` from row counts by day and status."""
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col(count))), F.lit(0))
    sums = [F.sum(count).alias("total_orders"), *[total(F.col(status) == value).alias(alias) for alias, value in wanted.items()]]
    if with_other:
        sums.append(total(~F.coalesce(F.col(status).isin(*wanted.values()), F.lit(False))).alias("other_orders"))
    daily = counts.groupBy(F.col(date).alias("order_date")).agg(*sums)
    return daily.withColumn("delivery_rate", safe_ratio(part, "total_orders"))


def daily_revenue(
    orders: DataFrame,
    payments: DataFrame,
    order_key: str,
    payment_key: str,
    amount: str,
    date: str,
) -> DataFrame:
    """Payments per order day, in exact decimals.

    Payments are summed per order before the join: the join then meets one row per order, however
    many payments a single order has, and reuses the partitioning of the sum.
    """
    paid = payments.groupBy(F.col(payment_key).alias("__paid_key")).agg(
        F.sum(F.col(amount).cast("decimal(18,2)")).alias("paid")
    )
    dated = orders.select(F.col(order_key).alias("__paid_key"), F.to_date(date).alias("order_date"))
    return (
        dated.join(paid, "__paid_key", "left")
        .groupBy("order_date")
        .agg(F.count("*").alias("total_orders"), F.coalesce(F.sum("paid"), F.lit(0)).cast("double").alias("revenue"))
    )


def cancellation_rate(orders: DataFrame, date: str, status: str, cancelled: str) -> DataFrame:
    """Share of cancelled orders per order day."""
    daily = orders.groupBy(F.to_date(date).alias("order_date")).agg(
        F.count("*").alias("total_orders"), F.count_if(F.col(status) == cancelled).alias("cancelled_orders")
    )
    return daily.withColumn("cancellation_rate", safe_ratio("cancelled_orders", "total_orders"))


def delivery_time(orders: DataFrame, purchased: str, delivered: str) -> DataFrame:
    """Mean seconds from purchase to delivery per order day, over the delivered orders."""
    taken = F.unix_timestamp(F.col(delivered).cast("timestamp")) - F.unix_timestamp(F.col(purchased).cast("timestamp"))
    return (
        orders.filter(F.col(delivered).isNotNull())
        .groupBy(F.to_date(purchased).alias("order_date"))
        .agg(F.count("*").alias("delivered_orders"), F.avg(taken).alias("avg_delivery_sec"))
    )
