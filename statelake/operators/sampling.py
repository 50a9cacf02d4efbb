"""Exact-size stratified sampling, and the child rows of a sample."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

# Sample size wanted per order status, and the seed.
ORDER_STATUS_CAPS = {
    "delivered": 8500,
    "shipped": 500,
    "canceled": 300,
    "unavailable": 300,
    "processing": 200,
    "invoiced": 190,
    "created": 5,
    "approved": 2,
}
SEED = 42

# Samples with at most this many rows in total may be broadcast as a key list.
MAX_BROADCAST_KEYS = 1_000_000
# Groups into which the rows of one hash prefix are split before they are ranked together.
SALTS = 1024
_HASH, _NEED, _EDGE, _SALT, _RANK = "__hash", "__need", "__edge", "__salt", "__rank"


def _caps_table(df: DataFrame, stratum: str, caps: Mapping[str, int]) -> DataFrame:
    rows = [(value, int(cap)) for value, cap in caps.items()]
    local = df.sparkSession.createDataFrame(rows, "stratum string, cap long")
    return local.select(F.col("stratum").cast(df.schema[stratum].dataType).alias(stratum), F.col("cap").alias(_NEED))


def _narrow(hashed: DataFrame, edges: DataFrame, stratum: str, start: int, digits: int) -> DataFrame:
    """Find, per stratum, the hash prefix in which the wanted number of rows is reached.

    ``edges`` holds one row per stratum: the prefix settled so far and the rows still wanted within
    it. The rows below that prefix are counted by their next ``digits`` hex digits, which at most
    ``16 ** digits`` groups per stratum can hold, and the running count gives the digits to add.
    """
    width = start + digits
    within = hashed.join(F.broadcast(edges), stratum).filter(F.col(_HASH).startswith(F.col(_EDGE)))
    histogram = within.groupBy(stratum, _NEED, F.substring(_HASH, 1, width).alias(_EDGE)).agg(F.count("*").alias("n"))
    running = Window.partitionBy(stratum).orderBy(_EDGE)
    counted = histogram.withColumn("upto", F.sum("n").over(running))
    reached = counted.filter(F.col("upto") >= F.col(_NEED)).groupBy(stratum).agg(
        F.min_by(F.struct(_EDGE, (F.col(_NEED) - F.col("upto") + F.col("n")).alias(_NEED)), _EDGE).alias("hit")
    )
    return reached.select(stratum, F.col(f"hit.{_EDGE}").alias(_EDGE), F.col(f"hit.{_NEED}").alias(_NEED))


def stratified_sample(
    df: DataFrame,
    stratum: str,
    caps: Mapping[str, int],
    key: str | Sequence[str],
    seed: int = SEED,
    levels: int = 2,
    digits: int = 3,
) -> DataFrame:
    """``min(cap, size)`` rows of each stratum named in ``caps``; other strata are dropped.

    A row's place in the draw is ``md5(key || '-' || seed)``, so the sample is repeatable and the
    same on every cluster size. Ranking a whole stratum would pull it into one task, and a stratum
    can be nearly the whole table. Instead two counting passes over ``stratum`` and ``key`` find the
    hash prefix at which each cap is reached; every row below it is in, every row above is out, and
    only the rows that share the prefix (about one in ``16 ** (levels * digits)``) are ranked.
    Copies of one key share a hash, so the ranking first runs within salted groups and only the
    survivors meet.
    """
    keys = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    hashed = df.withColumn(_HASH, F.md5(F.concat(text, F.lit(f"-{seed}"))))
    narrow = hashed.select(stratum, _HASH)
    wanted = _caps_table(df, stratum, {value: cap for value, cap in caps.items() if cap > 0})

    edges = wanted.withColumn(_EDGE, F.lit(""))
    for level in range(levels):
        edges = _narrow(narrow, edges, stratum, level * digits, digits)
    # a stratum smaller than its cap reaches no edge: all of it is wanted
    width = levels * digits
    limits = wanted.drop(_NEED).join(F.broadcast(edges), stratum, "left")

    prefix = F.substring(_HASH, 1, width)
    chosen = hashed.join(F.broadcast(limits), stratum).filter(F.col(_EDGE).isNull() | (prefix <= F.col(_EDGE)))
    on_edge = F.coalesce(prefix == F.col(_EDGE), F.lit(False))
    # Rows off the edge are in whatever their rank and are not moved at all. Edge rows are first cut to
    # the need within salted groups, so that a third of the table sharing one key stays spread out.
    sure = chosen.filter(~on_edge)
    edge = chosen.filter(on_edge).withColumn(_SALT, F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    order = [F.col(_HASH), *[F.col(c).asc_nulls_first() for c in [*keys, *_sortable(df, keys)]]]
    for group in ([stratum, prefix, _SALT], [stratum, prefix]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        edge = edge.withColumn(_RANK, rank).filter(F.col(_RANK) <= F.col(_NEED)).drop(_RANK)
    return sure.select(*df.columns).unionByName(edge.select(*df.columns))


def _sortable(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """The other columns, to decide between rows of one key; maps have no order and are left out."""
    return [f.name for f in df.schema.fields if f.name not in keys and not isinstance(f.dataType, (MapType, VariantType))]


def child_rows(children: DataFrame, sample: DataFrame, key: str, child_key: str | None = None, max_sample_rows: int | None = None) -> DataFrame:
    """Rows of ``children`` whose key is in ``sample``.

    With ``max_sample_rows``, the bound a sample claims to have (the sum of its caps), the sample is
    computed here, once; up to ``MAX_BROADCAST_KEYS`` keys are broadcast and the children are filtered in
    place. Otherwise it is a shuffled semi join, where adaptive execution splits a hot child key.
    """
    name = child_key or key
    keys = sample.select(F.col(key).alias(name)).distinct()
    claimed = max_sample_rows is not None and max_sample_rows <= MAX_BROADCAST_KEYS
    if claimed:
        found = keys.limit(MAX_BROADCAST_KEYS + 1).toArrow()
        if found.num_rows <= MAX_BROADCAST_KEYS:
            keys = F.broadcast(children.sparkSession.createDataFrame(found))
    return children.join(keys, name, "left_semi")
