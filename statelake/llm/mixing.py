"""Mixing sources to target weights along a time-varying curriculum.

Each source has a target number of words, found by water-filling: weights are shared out until no
source is asked for more than a fixed multiple of its own size. Within a source the documents stand
in a pseudo-random order; passes over that order are read until the target is reached, the last
document being cut at the word that reaches it. Each source also has a weight that changes linearly
over the run. Its integral is the source's cumulative demand, and inverting it turns a document's
place in the source into its position in training; the result is range-sorted by that position.

Defined cases: a NULL or empty text has size 0 and takes nothing; a NULL source is a source of its
own and comes last; rows with the same id and size are interchangeable; a source of size 0 has target
0; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statelake.llm.common import source_key, stored, words


@dataclass(frozen=True)
class MixRules:
    """``weights`` and ``schedules`` repeat over the sources in name order.

    A schedule is the weight at the start and at the end of training, relative to its mean; the two
    add up to 2. ``places`` is the number of hex digits that cut a source into slices, whose sums
    give each slice its offset, so that no source is ever ordered in one task.
    """

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    cap: int = 2
    schedules: tuple[tuple[float, float], ...] = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
    places: int = 3


def source_targets(sizes: DataFrame, rules: MixRules) -> DataFrame:
    """One row per source: its size, weight, target words and schedule.

    Capped sources are a prefix of the order by (cap / weight), so one pass over prefix sums finds
    where the shared level lies.
    """
    sources = sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy("src")
    turn = (F.row_number().over(by_name) - 1) % len(rules.weights)
    phase = (F.row_number().over(by_name) - 1) % len(rules.schedules)
    pick = lambda values, at: F.element_at(F.array(*[F.lit(v) for v in values]), at.cast("int") + 1)
    weighed = sources.select(
        "src",
        "source_size",
        pick([float(w) for w in rules.weights], turn).alias("weight"),
        pick([float(a) for a, _ in rules.schedules], phase).alias("opens"),
        pick([float(b) for _, b in rules.schedules], phase).alias("closes"),
    )
    limit = (F.col("source_size") * rules.cap).cast("double")
    order = Window.orderBy(F.col("ceiling") / F.col("weight"), "src")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    here_on = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.col("demand") - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0))) / F.sum("weight").over(here_on)
    filled = (
        weighed.withColumn("ceiling", limit)
        .withColumn("demand", F.sum("source_size").over(whole) * F.lit(rules.share))
        .withColumn("level", level)
        .withColumn("capped", F.col("level") * F.col("weight") >= F.col("ceiling"))
        .withColumn("shared", F.max(F.when(~F.col("capped"), F.col("level"))).over(whole))
    )
    target = F.when(F.col("capped"), F.col("ceiling")).otherwise(F.col("shared") * F.col("weight"))
    return filled.select("src", "source_size", target.alias("target"), "opens", "closes")


def progress(part: Column, opens: Column, closes: Column) -> Column:
    """The time at which a source with a linear weight has delivered ``part`` of its demand."""
    slope = closes - opens
    root = (F.sqrt(opens * opens + 2 * slope * part) - opens) / slope + F.lit(0.0)
    return F.when(slope == 0, part).otherwise(root)


def mix(docs: DataFrame, rules: MixRules = MixRules(), text: str = "text", source: str = "source") -> DataFrame:
    """One row per document, sorted by training position.

    ``taken`` is the number of words the mix reads from the document over all passes, ``positions``
    the time in [0, 1] of each pass that reads any of it, ``position`` the first of them.
    """
    place = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sizes = stored(
        docs.select(
            "doc_id",
            source_key(F.col(source)).alias("src"),
            F.size(words(F.col(text))).cast("long").alias("size"),
            place.alias("place"),
            F.substring(place, 1, rules.places).alias("slice"),
        ),
        "mix-sizes",
    )
    earlier = Window.partitionBy("src").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = sizes.groupBy("src", "slice").agg(F.sum("size").alias("slice_size"))
    offsets = slices.select("src", "slice", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)).alias("offset"))
    plan = offsets.join(source_targets(sizes, rules), "src")
    inside = Window.partitionBy("src", "slice").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.join(plan, ["src", "slice"]).withColumn(
        "start", F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )
    budget = F.floor("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0).cast("long")
    last = F.least(F.greatest(F.col("rest") - F.col("start"), F.lit(0)), F.col("size"))
    counted = (
        placed.withColumn("budget", budget)
        .withColumn("passes", passes)
        .withColumn("rest", F.col("budget") - F.col("passes") * F.col("source_size"))
        .withColumn("taken", F.col("passes") * F.col("size") + last)
    )
    reads = F.filter(
        F.transform(F.sequence(F.lit(0), F.col("passes")), lambda k: k * F.col("source_size") + F.col("start")),
        lambda at: (F.col("size") > 0) & (at < F.col("budget")),
    )
    timed = counted.withColumn(
        "positions", F.transform(reads, lambda at: progress(at / F.col("budget"), F.col("opens"), F.col("closes")))
    ).withColumn("position", F.get("positions", F.lit(0)))
    result = timed.select("doc_id", "size", "source_size", "target", "taken", "position", "positions")
    return result.orderBy(F.col("position").asc_nulls_last(), "doc_id", "size")
