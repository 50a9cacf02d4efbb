"""Timestamps: lenient parsing, ISO text, whole-second differences, processing clocks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISO_ZONED = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
ISO_NAIVE = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def parse_timestamp(column: Column | str, pattern: str | None = None) -> Column:
    """Text to timestamp, NULL where it cannot be read.

    Without a pattern the ISO reader is used, which takes any number of fraction digits. A fixed
    six-digit pattern loses every value whose microseconds happened to be zero and not printed.
    """
    text = F.col(column) if isinstance(column, str) else column
    return F.try_to_timestamp(text, F.lit(pattern)) if pattern else F.try_to_timestamp(text)


def parse_columns(df: DataFrame, columns: list[str], pattern: str | None = None) -> DataFrame:
    """``parse_timestamp`` applied in place to several columns in one projection."""
    return df.withColumns({name: parse_timestamp(name, pattern) for name in columns})


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole seconds: each side loses its fraction before subtracting."""
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def iso_zoned(column: Column | str) -> Column:
    """ISO text with microseconds and zone offset, such as ``2024-01-01T00:00:00.000000+00:00``."""
    return F.date_format(column, ISO_ZONED)


def iso_naive(column: Column | str) -> Column:
    """ISO text with microseconds and no zone."""
    return F.date_format(column, ISO_NAIVE)


def clock(as_of: dt.datetime | str | Column | None = None) -> Column:
    """The stamp of a run: a fixed instant when given, else the time the query starts."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp")
