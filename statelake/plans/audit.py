"""Checks across the layers, and distinct counts kept beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statelake.operators.fingerprint import compare, fingerprints
from statelake.operators.sketches import SKETCH_SCHEMA, day_sketches, unite
from statelake.operators.summary import daily_summary
from statelake.plans.silver import OFFSET_RULES, SilverRules, current_state
from statelake.plans.silver import usable_records
from statelake.sources.snapshots import SnapshotTable

# Stamped by the run that wrote the row, so it says nothing about the row.
_STAMPS = {"updated_at"}


def state_fingerprints(state: DataFrame) -> DataFrame:
    """Fingerprints of state rows by day, without the stamps of the runs that wrote them."""
    return fingerprints(state, "event_date", [c for c in state.columns if c not in _STAMPS])


def audit_layers(bronze: DataFrame, silver: DataFrame, gold: DataFrame, rules: SilverRules = OFFSET_RULES) -> DataFrame:
    """One row per day of any layer: what the raw layer gives, what the state holds, what the summary says.

    ``raw_orders`` and ``state_orders`` are row counts, ``same_state`` whether every value of the day's
    state rows is what the raw layer gives, ``same_summary`` whether the summary row is the state's.
    Every layer is read once, where it lies, and only numbers per day meet.
    """
    expected = current_state(usable_records(bronze, rules), rules)
    states = compare(state_fingerprints(expected), state_fingerprints(silver.select(*expected.columns))).alias("s")
    numbers = [c for c in gold.columns if c not in ("order_date", *_STAMPS)]
    told = fingerprints(gold, "order_date", numbers)
    counted = fingerprints(daily_summary(silver), "order_date", numbers)
    sums = compare(counted, told).alias("g")
    joined = states.join(sums, F.col("s.day").eqNullSafe(F.col("g.day")), "full_outer")
    return joined.select(
        F.coalesce("s.day", "g.day").alias("day"),
        F.coalesce("s.left_rows", F.lit(0)).alias("raw_orders"),
        F.coalesce("s.right_rows", F.lit(0)).alias("state_orders"),
        F.coalesce("s.same", F.lit(True)).alias("same_state"),
        F.coalesce("g.same", F.lit(True)).alias("same_summary"),
    )


def sketch_table(path: str) -> SnapshotTable:
    """One sketch per day."""
    return SnapshotTable(path, SKETCH_SCHEMA)


def add_to_sketches(spark: SparkSession, events: DataFrame, day: str, key: str, table: SnapshotTable) -> None:
    """Take new rows into the stored sketches. Rows taken in again change nothing, so a repeated run is harmless."""
    table.replace(unite(table.read(spark), day_sketches(events, day, key)))
