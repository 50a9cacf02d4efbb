"""Counts that describe a table, each one a single aggregate over one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    return df.agg(F.count("*").alias(alias))


def value_counts(df: DataFrame, column: str, alias: str = "row_count", drop_null: bool = False, ordered: bool = True) -> DataFrame:
    """Rows per value, most frequent first; equal counts follow the value."""
    rows = df.filter(F.col(column).isNotNull()) if drop_null else df
    counts = rows.groupBy(column).agg(F.count("*").alias(alias))
    return counts.orderBy(F.desc(alias), F.asc(column)) if ordered else counts


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column, as one row of counts."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in (columns or df.columns)])


def distinct_count(df: DataFrame, column: str, alias: str = "distinct_count", relative_error: float | None = None) -> DataFrame:
    """Distinct non-NULL values. Exact unless an error is allowed, in which case a fixed-size sketch is merged."""
    if relative_error is None:
        return df.agg(F.count_distinct(column).alias(alias))
    return df.agg(F.approx_count_distinct(column, relative_error).alias(alias))


def reconcile(df: DataFrame, key: str) -> DataFrame:
    """Row counts before and after deduplication on ``key``, in one pass.

    NULL counts as one key, as ``dropDuplicates`` treats it.
    """
    counts = df.agg(
        F.count("*").alias("rows_before"),
        (F.count_distinct(key) + F.max(F.col(key).isNull().cast("long"))).alias("kept"),
    )
    kept = F.coalesce("kept", F.lit(0))
    return counts.select(
        "rows_before",
        kept.alias("rows_after"),
        (F.col("rows_before") - kept).alias("duplicates_removed"),
    )


def top_rows(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """The first ``n`` rows; each task keeps only its own best ``n``."""
    return df.orderBy(*order).limit(n)
