"""A Merkle tree over a dataset, built and proven level by level as joins and pivots.

Rows become leaf digests; leaves of a source, in the order of their ids, are grouped 16 at a time until
one node is left, the source's subroot; subroots, in the order of their sources, form the top tree in
the same way. A level is one aggregation: conditional aggregates spread the children of each parent
into 16 columns, one per slot. All columns joined together hash to the parent; all but the own slot are
the siblings a proof needs. Proofs run down from the root: each parent hands its own path, with the
siblings of its level in front, to its children. Hashes are hexadecimal text throughout.

Places within a source come from ``ranks``, so a source with most of the rows is never ordered in one
task. A parent has at most 16 children, whatever the source; the levels above hold a sixteenth of the
rows each, so only the leaf level moves data of the size of the table, and texts do not move at all.

Defined cases: a NULL field counts as ``-`` and differs from an empty one; rows with a NULL id come
first in their source and are never tampered with; rows with equal ids stand in the order of their leaf
digests, equal rows count as leaves each; a NULL source is one of its own and comes first; a source of
one row has its leaf as subroot, one source has its subroot as root; very long texts are hashed where
they lie; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statelake.llm.common import stored
from statelake.llm.ranks import dealt, placed

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class TreeRules:
    """``fanout`` children to a node; ``tampered`` is the SQL condition for rows whose text the check
    alters before it folds their proof."""

    fanout: int = 16
    tampered: str = "crc32(CAST(doc_id AS STRING)) % 5 = 0"


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts put together, as lower-case hexadecimal text."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes in front, so that no two rows are written alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, rules: TreeRules = TreeRules()) -> DataFrame:
    """``doc_id``, ``part`` (the source as a key that is never NULL, NULL first), ``leaf`` and
    ``altered``, the leaf of the tampered row (NULL where nothing changed)."""
    others = [field(F.col(c)) for c in FIELDS if c != "text"]
    changed = F.expr(rules.tampered) & F.col("text").rlike("[A-Z]")
    return docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("0")).alias("part"),
        digest(*others, field(F.col("text"))).alias("leaf"),
        F.when(changed, digest(*others, field(F.translate("text", UPPER, LOWER)))).alias("altered"),
    )


def _slots(rules: TreeRules) -> list[str]:
    return [f"c{k}" for k in range(rules.fanout)]


def pivot(nodes: DataFrame, rules: TreeRules, payload: Column | None = None) -> DataFrame:
    """The parents of ``nodes`` (``part``, ``place``, ``size``, ``node``), each with its children in
    columns, empty where a slot has none, and ``payload`` of every child in columns beside them."""
    slot = F.col("place") % rules.fanout
    spread = [F.max(F.when(slot == k, F.col("node"))).alias(c) for k, c in enumerate(_slots(rules))]
    if payload is not None:
        spread += [F.max(F.when(slot == k, payload)).alias(f"p{k}") for k in range(rules.fanout)]
    parent = F.floor(F.col("place") / rules.fanout).cast("long")
    rows = nodes.groupBy("part", parent.alias("parent"), "size").agg(*spread)
    above = F.ceil(F.col("size") / rules.fanout).cast("long")
    return rows.withColumn("node", digest(*[F.coalesce(c, F.lit("")) for c in _slots(rules)])).withColumn("above", above)


def children(pivoted: DataFrame, rules: TreeRules) -> DataFrame:
    """Each child again, with what stands before and after it among its siblings."""
    columns = [F.coalesce(c, F.lit("")) for c in _slots(rules)]
    joined = lambda some: F.concat(*some) if some else F.lit("")
    carried = "p0" in pivoted.columns
    each = F.array(
        *[
            F.struct(
                F.lit(k).alias("slot"), F.col(c).alias("node"),
                F.struct(joined(columns[:k]).alias("before"), joined(columns[k + 1 :]).alias("after")).alias("step"),
                *([F.col(f"p{k}").alias("payload")] if carried else []),
            )
            for k, c in enumerate(_slots(rules))
        ]
    )
    present = F.filter(each, lambda x: x["node"].isNotNull())
    kept = [c for c in ("part", "parent", "top", "path") if c in pivoted.columns]
    rows = pivoted.select(*kept, F.explode(present).alias("child"))
    place = F.col("parent") * rules.fanout + F.col("child.slot")
    return rows.select(*[c for c in kept if c != "parent"], place.alias("place"), "child.*")


NO_PATH = "array<struct<before:string,after:string>>"


def climb(nodes: DataFrame, largest: int, rules: TreeRules, payload: Column | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """The top node of every part, and the pivoted levels from the bottom up.

    A part leaves the climb as soon as one node of it is left. ``largest`` is the size of the largest
    part; it gives the number of levels. Each level is written once and read on the way up and down.
    """
    tops, levels = [], []
    while True:
        tops.append(nodes.filter("size = 1").select("part", F.col("place"), "node"))
        if largest <= 1:
            break
        level = stored(pivot(nodes.filter("size > 1"), rules, payload if not levels else None), f"merkle-{len(levels)}")
        levels.append(level)
        nodes = level.select("part", F.col("parent").alias("place"), F.col("above").alias("size"), "node")
        largest = -(-largest // rules.fanout)
    top = tops[0]
    for other in tops[1:]:
        top = top.unionByName(other)
    return top, levels


def descend(tops: DataFrame, levels: list[DataFrame], rules: TreeRules) -> list[DataFrame]:
    """From the top down: the nodes below every level, each with its ``path``, bottom level first.

    ``tops`` has each part's ``top`` node and the ``path`` above it.
    """
    found: list[DataFrame] = []
    above: DataFrame | None = None
    for level in reversed(levels):
        entry = level.filter("above = 1").join(tops.select("part", "top", "path"), "part")
        if above is not None:
            inner = level.filter("above > 1").join(above.select("part", F.col("place").alias("parent"), "top", "path"), ["part", "parent"])
            entry = entry.unionByName(inner)
        below = children(entry, rules)
        above = below.withColumn("path", F.concat(F.array("step"), "path"))
        found.insert(0, above)
    return found


def _one(df: DataFrame, column: str) -> int:
    return df.agg(F.max(column)).first()[0] or 0


def manifest(docs: DataFrame, rules: TreeRules = TreeRules()) -> DataFrame:
    """One row per row of ``docs``: its leaf, subroot, root, the digest of its proof, the root that the
    (tampered) leaf folds to, whether that is the root, and the number of hashes on the way."""
    hashed = stored(leaves(docs, rules), "merkle-leaves")
    sorted_rows = dealt(hashed, ["part"], [F.col("doc_id").asc_nulls_first(), F.col("leaf")], "merkle-dealt")
    bottom = stored(
        placed(sorted_rows, ["part"]).select(
            "part", F.col("__place").alias("place"), F.col("__size").alias("size"), F.col("leaf").alias("node"), "doc_id", "altered"
        ),
        "merkle-bottom",
    )
    largest = _one(bottom, "size")
    subroots, levels = climb(bottom, largest, rules, F.struct("doc_id", "altered"))

    subroots = stored(subroots.select("part", "node"), "merkle-subroots")
    sources = placed(dealt(subroots, [], [F.col("part")], "merkle-sources"), [])
    upper = stored(
        sources.select(F.lit("").alias("part"), F.col("__place").alias("place"), F.col("__size").alias("size"), "node", F.col("part").alias("source")),
        "merkle-upper",
    )
    above, root = paths_above(upper, rules)
    found = bottom.filter("size = 1").join(above, "part").select(F.col("node").alias("leaf"), "doc_id", "altered", "top", "path")
    if levels:
        proven = descend(above, levels, rules)[0]
        found = found.unionByName(proven.select(F.col("node").alias("leaf"), "payload.doc_id", "payload.altered", "top", "path"))
    fold = F.aggregate("path", F.coalesce("altered", "leaf"), lambda acc, s: digest(s["before"], acc, s["after"]))
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    return found.withColumn("folded_root", fold).select(
        "doc_id", "leaf", F.col("top").alias("subroot"), F.lit(root).cast("string").alias("root"),
        F.sha2(proof, 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.lit(root)).alias("verified"), F.size("path").cast("long").alias("n_steps"),
    )


def paths_above(upper: DataFrame, rules: TreeRules) -> tuple[DataFrame, str | None]:
    """The path above every source's top node, and the root."""
    root, levels = climb(upper, _one(upper, "size"), rules, F.struct("source"))
    first = root.first()
    value = first["node"] if first else None
    none = F.array().cast(NO_PATH)
    alone = upper.filter("size = 1").select(F.col("source").alias("part"), F.col("node").alias("top"), none.alias("path"))
    if not levels:
        return stored(alone, "merkle-paths"), value
    below = descend(root.select("part", F.col("node").alias("top"), none.alias("path")), levels, rules)[0]
    return stored(below.select(F.col("payload.source").alias("part"), F.col("node").alias("top"), "path"), "merkle-paths"), value
