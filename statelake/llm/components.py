"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statelake.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    bigger = both.filter(F.col("v") > F.col("u")).join(least, "u")
    return bigger.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)`` but the roots themselves.

    Each round halves the remaining paths, is written to the shared folder and compared with the one
    before by a count and a sum of hashes. Only those two numbers reach the driver.
    """
    now = stored(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    seen = _state(now)
    while True:
        now = stored(_small_star(_large_star(now)), "edges")
        state = _state(now)
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
