"""Event identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(*columns: str) -> Column:
    """Same inputs, same id: a replay of the source yields ids that deduplicate against the first run."""
    return F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]), 256)


def random_id() -> Column:
    """A fresh UUID per row. Rows change identity on recomputation; write them out before reuse."""
    return F.expr("uuid()")
