"""``MERGE`` semantics as joins, for tables whose provider has no row-level writes.

Rules reproduced: a NULL key never matches, so such source rows are inserted and such target rows
stay; a matched row whose guard is false or NULL stays; key columns are never updated; unmatched
target rows stay unless ``delete_missing``; two source rows for one key are an error.

A guard is a SQL condition over the aliases ``t`` (target) and ``s`` (source), so the same text
serves these joins and a provider's own ``MERGE``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HERE = "__here"
_SPREAD = "__spread"
_COPY = "__copy"
_OLD = "__old_"


def not_older(column: str = "event_time") -> str:
    """Accept a source row at least as new as the stored one; equal times update."""
    return f"s.{column} >= t.{column}"


def not_older_then(column: str, tie: str) -> str:
    """As ``not_older``, with ties on ``column`` decided by ``tie``."""
    return f"(s.{column} > t.{column} OR (s.{column} = t.{column} AND s.{tie} >= t.{tie}))"


def or_unset(column: str, guard: str) -> str:
    """Also accept when the stored ``column`` is NULL; otherwise such a row could never change again."""
    return f"(t.{column} IS NULL OR {guard})"


def and_changed(identity: Sequence[str], guard: str) -> str:
    """Reject the event that is stored already, so a repeated run rewrites nothing."""
    same = " AND ".join(f"s.{c} <=> t.{c}" for c in identity)
    return f"({guard} AND NOT ({same}))"


def _any_null(keys: Sequence[str]) -> Column:
    condition = F.lit(False)
    for key in keys:
        condition = condition | F.col(key).isNull()
    return condition


def _spread_nulls(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add a second join column that scatters NULL keys over the reducers.

    NULL keys match nothing, yet an outer join hashes all of them to one task. The partition id is
    used because it does not change when a stage is retried.
    """
    return df.withColumn(_SPREAD, F.when(_any_null(keys), F.spark_partition_id()).otherwise(F.lit(-1)))


def _reject_copies(source: DataFrame, keys: Sequence[str], also: Sequence[str] = (_SPREAD,)) -> DataFrame:
    """Raise while running when a non-NULL key occurs twice.

    The window clusters and sorts on the join columns, so it rides on the exchange and sort that the
    join needs anyway.
    """
    window = Window.partitionBy(*keys, *also).orderBy(*keys)
    numbered = source.withColumn(_COPY, F.row_number().over(window))
    broken = (F.col(_COPY) > 1) & ~_any_null(keys)
    message = F.lit(f"merge: more than one source row for a key {tuple(keys)}")
    here = F.when(broken, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return numbered.withColumn(_HERE, here).drop(_COPY)


def _equal(keys: Sequence[str]) -> Column:
    condition = F.col(f"t.{keys[0]}") == F.col(f"s.{keys[0]}")
    for key in keys[1:]:
        condition = condition & (F.col(f"t.{key}") == F.col(f"s.{key}"))
    return condition


def _matching(keys: Sequence[str]) -> Column:
    return _equal([*keys, _SPREAD])


def _guard(guard: str | None) -> Column:
    return F.lit(True) if guard is None else F.coalesce(F.expr(guard), F.lit(False))


def _source_value(source: DataFrame, column: str, like: DataFrame) -> Column:
    if column in source.columns:
        return F.col(f"s.{column}")
    return F.lit(None).cast(like.schema[column].dataType)


def _tag_source(source: DataFrame, keys: Sequence[str], unique_source: bool) -> DataFrame:
    spread = _spread_nulls(source, keys)
    return spread.withColumn(_HERE, F.lit(True)) if unique_source else _reject_copies(spread, keys)


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    guard: str | None = None,
    update_columns: Sequence[str] | None = None,
    delete_missing: bool = False,
    unique_source: bool = False,
) -> DataFrame:
    """The target after merging ``source`` into it, with the target's columns.

    ``update_columns`` defaults to all non-key columns both sides have. ``unique_source`` skips the
    duplicate check when the source is one row per key by construction. One shuffle of each side on
    the key; no side is broadcast, so nothing depends on the source being small.
    """
    updated = set(update_columns) if update_columns is not None else set(source.columns)
    t = _spread_nulls(target, keys).withColumn(_HERE, F.lit(True)).alias("t")
    s = _tag_source(source, keys, unique_source).alias("s")
    joined = t.join(s, _matching(keys), "full_outer")

    inserted = F.col(f"t.{_HERE}").isNull()
    replaced = F.col(f"t.{_HERE}").isNotNull() & F.col(f"s.{_HERE}").isNotNull() & _guard(guard)
    if delete_missing:
        joined = joined.filter(F.col(f"s.{_HERE}").isNotNull())

    output = []
    for column in target.columns:
        take = inserted | replaced if column in updated and column not in keys else inserted
        kept = F.col(f"t.{column}")
        output.append(F.when(take, _source_value(source, column, target)).otherwise(kept).alias(column))
    return joined.select(*output)


def changed_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    guard: str | None = None,
    update_columns: Sequence[str] | None = None,
    locate: str | None = None,
    unique_source: bool = False,
    few: bool = False,
    remember: Sequence[str] = (),
) -> DataFrame:
    """Only the rows a merge inserts or updates, in their final form.

    With ``locate`` the column ``__old_<locate>`` tells where an updated row lies now (NULL for an
    insert), and ``__updated`` tells the two apart. Columns to ``remember`` get an old value likewise. One join from the source to the target, of which
    only the columns are read that the update does not replace. ``few`` says that the keys of the
    source are known to be small: they are then broadcast to cut the target down where it lies. NULL
    keys match nothing; they pass by the join, so they never gather in a task.
    """
    updated = set(update_columns) if update_columns is not None else set(source.columns)
    null = _any_null(keys)
    named, nameless = source.filter(~null), source.filter(null)
    stored = target.filter(~null)
    if few:
        stored = stored.join(F.broadcast(named.select(*keys).distinct()), list(keys), "left_semi")
    t = stored.withColumn(_HERE, F.lit(True)).alias("t")
    s = (named.withColumn(_HERE, F.lit(True)) if unique_source else _reject_copies(named, keys, [])).alias("s")
    joined = s.join(t, _equal(keys), "left").filter(F.col(f"t.{_HERE}").isNull() | _guard(guard))

    inserted = F.col(f"t.{_HERE}").isNull()
    output = []
    for column in target.columns:
        value = _source_value(source, column, target)
        if column in keys:
            # always true, or an error: it keeps the duplicate check in any plan that uses the key
            value = F.when(F.col(f"s.{_HERE}"), value)
        elif column not in updated:
            value = F.when(inserted, value).otherwise(F.col(f"t.{column}"))
        output.append(value.alias(column))
    kept = list(dict.fromkeys([*([locate] if locate else []), *remember]))
    output += [F.col(f"t.{c}").alias(f"{_OLD}{c}") for c in kept]
    output.append(F.col(f"t.{_HERE}").isNotNull().alias("__updated"))
    passed = [
        (F.col(c) if c in source.columns else F.lit(None).cast(target.schema[c].dataType)).alias(c) for c in target.columns
    ]
    passed += [F.lit(None).cast(target.schema[c].dataType).alias(f"{_OLD}{c}") for c in kept]
    passed.append(F.lit(False).alias("__updated"))
    return joined.select(*output).unionByName(nameless.select(*passed))


def replace_rows(target: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` without the keys of ``changed``, plus ``changed``.

    Equal to ``merge_rows`` when ``changed`` comes from ``changed_rows``. A small ``changed`` is
    broadcast by Spark from its measured size and the target streams through without a shuffle.
    """
    null = _any_null(keys)
    left, right = target.filter(~null).alias("t"), changed.filter(~null).select(*keys).alias("s")
    kept = left.join(right, _equal(keys), "left_anti").select(*[F.col(f"t.{c}") for c in target.columns])
    return kept.unionByName(target.filter(null)).unionByName(changed.select(*target.columns))
