"""Aggregate expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def status_counts(status: str, wanted: Mapping[str, str]) -> list[Column]:
    """One conditional count per ``alias: value``. All of them combine on the map side."""
    return [F.count_if(F.col(status) == value).alias(alias) for alias, value in wanted.items()]


def other_count(status: str, wanted: Mapping[str, str], alias: str) -> Column:
    """Rows whose status is none of the wanted values, NULL included, so that counts add up to the total."""
    known = F.coalesce(F.col(status).isin(*wanted.values()), F.lit(False))
    return F.count_if(~known).alias(alias)


def safe_ratio(part: str, whole: str) -> Column:
    """``part / whole``, and 0.0 where there is nothing to divide by."""
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))
