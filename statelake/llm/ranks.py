"""Places and running sums within groups, without ever ordering a group in one task.

Rows are dealt out by ranges of (group, order), sorted inside each range and written; sums inside a
range need only that range, and a small table of every range's totals gives what comes before it. So a
group that holds most of all rows is spread over as many tasks as it needs. Rows that are equal in
every ordering column are interchangeable; they are dealt out by row number, so copies spread as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statelake.llm.common import stored


def dealt(df: DataFrame, group: Sequence[str], order: Sequence[Column], label: str) -> DataFrame:
    """``df``, written in ranges of group and order, with the range (``__range``) and a number that
    ascends in this order over all rows (``__at``, without gaps inside a range).

    ``df`` is scanned twice (range bounds are sampled), so it should be a written table or a cheap plan.
    """
    keys = [*[F.col(c) for c in group], *order, F.col("__scan")]
    spread = df.withColumn("__scan", F.monotonically_increasing_id()).repartitionByRange(*keys)
    numbered = spread.sortWithinPartitions(*keys).drop("__scan")
    return stored(numbered.withColumn("__range", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()), label)


def _earlier(totals: DataFrame, group: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Per range and group, the sums over the earlier ranges of the group."""
    before = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumns({c: F.coalesce(F.sum(c).over(before), F.lit(0)) for c in sums})


def placed(fixed: DataFrame, group: Sequence[str]) -> DataFrame:
    """``dealt`` rows with ``__place``, 0-based, and ``__size`` in their group, which must not be NULL."""
    totals = fixed.groupBy(*group, "__range").agg(F.count("*").alias("__size"), F.count("*").alias("__before"), F.min("__at").alias("__first"))
    whole = totals.withColumn("__size", F.sum("__size").over(Window.partitionBy(*group)))
    joined = fixed.join(_earlier(whole, group, ["__before"]), ["__range", *group])
    place = F.col("__before") + F.col("__at") - F.col("__first")
    return joined.withColumn("__place", place).select(*fixed.columns, "__place", "__size")


def running(fixed: DataFrame, group: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """``dealt`` rows with, for every ``new: old`` of ``sums``, the sum of ``old`` up to and with the row."""
    totals = fixed.groupBy(*group, "__range").agg(*[F.sum(old).alias(f"__sum_{new}") for new, old in sums.items()])
    before = _earlier(totals, group, [f"__sum_{new}" for new in sums])
    inside = Window.partitionBy("__range", *group).orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    local = fixed.withColumns({new: F.sum(old).over(inside) for new, old in sums.items()})
    joined = local.join(before, ["__range", *group])
    return joined.select(*fixed.columns, *[(F.col(new) + F.col(f"__sum_{new}")).alias(new) for new in sums])
