"""Deduplication and latest-row selection.

``row_number() = 1`` makes Catalyst plan a group limit on both sides of the exchange, so each map
task sends at most one row per key. A key that owns a third of the log therefore costs the reducer
one row per map task and never gathers in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def _descending(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order]


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first under ``order``, where plain names sort descending with NULLs last.

    End ``order`` in columns that are unique within a key, or the survivor of a tie is arbitrary.
    """
    window = Window.partitionBy(*keys).orderBy(*_descending(order))
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def dedup_newest(
    df: DataFrame,
    keys: Sequence[str] = ("event_id",),
    order: Sequence[str | Column] = ("ingestion_time", "offset"),
) -> DataFrame:
    """Of several copies of an event keep the one that came in last."""
    return latest_by(df, keys, order)


def drop_copies(df: DataFrame, keys: Sequence[str] = ("event_id",)) -> DataFrame:
    """Keep an arbitrary copy per key. Cheaper to state, but not reproducible when copies differ."""
    return df.dropDuplicates(list(keys))


def rows_of_changed_keys(history: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All history of the keys that occur in ``changed``.

    Ranking an increment alone can let an older row of equal event time win; ranking the whole
    history of just the changed keys cannot. The keys are made distinct before they move, so a key
    that fills the increment still travels once per task.
    """
    return history.join(changed.select(*keys).distinct(), list(keys), "left_semi")
