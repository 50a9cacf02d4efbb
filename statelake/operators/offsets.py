"""Log positions as DataFrames of ``(topic, partition, next_offset)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# A log has far fewer partitions than this; beyond it positions are joined by shuffle instead.
MAX_BROADCAST_POSITIONS = 100_000
# Up to so many are written into the filter itself, which a file scan then prunes by.
MAX_LITERAL_POSITIONS = 256
_SLOT = ["topic", "partition"]


def next_offsets(log: DataFrame) -> DataFrame:
    """Where the next batch starts: one past the highest offset seen, per topic and partition."""
    return log.groupBy(*_SLOT).agg((F.max("offset") + 1).alias("next_offset"))


def advance_offsets(stored: DataFrame, seen: DataFrame) -> DataFrame:
    """Merge two position sets, keeping the further one of each partition.

    A partition missing on either side keeps its position, so one that was silent in this batch is
    not read again from its beginning.
    """
    both = stored.select(*_SLOT, "next_offset").unionByName(seen.select(*_SLOT, "next_offset"))
    return both.groupBy(*_SLOT).agg(F.max("next_offset").alias("next_offset"))


def local_if_small(df: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """``df`` as local rows when it holds at most ``max_rows``; otherwise untouched.

    Runs one job that fetches no more than ``max_rows + 1`` rows.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df, False
    return df.sparkSession.createDataFrame(rows, df.schema), True


def _from_positions(rows: list[Row]) -> Column:
    """The condition of ``resume`` over a few positions, in plain comparisons."""
    new = F.lit(False)
    known = F.lit(False)
    for row in rows:
        here = (F.col("topic") == row["topic"]) & (F.col("partition") == row["partition"])
        known = known | here
        new = new | (here & (F.col("offset") >= row["next_offset"]))
    unknown = ~known | F.col("topic").isNull() | F.col("partition").isNull()
    return new | (unknown & (F.col("offset") >= 0))


def resume(log: DataFrame, positions: DataFrame) -> DataFrame:
    """The part of ``log`` at or after the stored positions.

    A record whose partition has no position, or whose topic or partition is NULL, counts from zero; a
    position without an offset is zero, one without a topic or partition concerns nobody; of several
    positions of a partition the furthest counts; a record without an offset is never new.

    The positions are counted first. Few of them become a filter of plain comparisons, which reaches
    the scan of a log in files. Up to ``MAX_BROADCAST_POSITIONS`` they travel by broadcast and
    the log is filtered where it lies; above that the join shuffles. All three keep the same rows.
    """
    named = positions.filter(F.col("topic").isNotNull() & F.col("partition").isNotNull())
    furthest = named.groupBy(*_SLOT).agg(F.coalesce(F.max("next_offset"), F.lit(0)).alias("next_offset"))
    small, fits = local_if_small(furthest, MAX_BROADCAST_POSITIONS)
    if fits and len(rows := small.limit(MAX_LITERAL_POSITIONS + 1).collect()) <= MAX_LITERAL_POSITIONS:
        return log.filter(_from_positions(rows))
    side = F.broadcast(small) if fits else small
    joined = log.join(side, _SLOT, "left")
    return joined.filter(F.col("offset") >= F.coalesce("next_offset", F.lit(0))).select(*log.columns)
