"""Describe a table of orders before using it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from statelake.operators.profile import distinct_count, null_counts, row_count, value_counts


def profile_table(
    df: DataFrame, key: str, category: str, nullable: Sequence[str]
) -> dict[str, DataFrame]:
    """Frequency of ``category``, NULLs of the ``nullable`` columns, and rows against distinct keys."""
    return {
        "category": value_counts(df, category, drop_null=True),
        "nulls": null_counts(df, nullable),
        "rows": row_count(df),
        "keys": distinct_count(df, key),
    }
