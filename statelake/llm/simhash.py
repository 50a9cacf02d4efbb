"""Near-duplicates by SimHash with deletion-variant signatures.

A fingerprint has 64 bits, two fingerprints link when at most two bits differ. They are cut into two
segments, so one of the segments differs by at most one bit, and every segment is indexed with that
bit as a wildcard. The other segment then differs by at most what is left; one of its pieces is equal
and joins the key, which makes the keys selective:

* first segment equal, and one of three pieces of the second;
* second segment equal, and one of three pieces of the first;
* first segment with one wildcard, and one of two pieces of the second.

Fingerprints meet by equality of a key and are verified. A key fixes at least 42 bits, so a group has
at most 2**22 members whatever the corpus; large groups look their neighbours up by flipping bits
instead of comparing all pairs. Copies share a fingerprint and enter as one. Links become components
by star contraction.

Defined cases: a text without words (NULL, empty, white space) has fingerprint zero; repeated rows
get equal results; a NULL id gets the component of its text and is never one itself, unless all ids
there are NULL; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from statelake.llm.common import fit_python, stored
from statelake.llm.components import components

SEED = 42
SHINGLE = 3
MAX_BITS = 2
SMALL_GROUP = 48
VERIFY_ROWS = 1 << 17


def fingerprint(text: str | None) -> int:
    """The SimHash of one text."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= SHINGLE:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        starts = [0, *(ends[:-SHINGLE] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist(), strict=True)]
    found = np.array(hashes, dtype=np.uint64)
    bits = np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(found), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, fp)`` for every row, with the columns ``carry``."""
    fit_python(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], dtype=np.uint64)
            columns = [batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", *carry])

    sent = docs.select("doc_id", text, *carry)
    kinds = [("doc_id", sent.schema[0].dataType), ("fp", LongType()), *((f.name, f.dataType) for f in sent.schema[2:])]
    return sent.mapInArrow(run, StructType([StructField(*k) for k in kinds]))


def signatures(fps: np.ndarray) -> np.ndarray:
    """The 70 keys of every fingerprint, as rows; equal keys of different kinds never clash."""
    one = lambda n: np.uint64(n)
    high, low = fps >> one(32), fps & one(0xFFFFFFFF)
    keys = []
    for half, (kept, other) in enumerate(((high, low), (low, high))):
        for piece, (shift, mask) in enumerate(((0, 0x7FF), (11, 0x7FF), (22, 0x3FF))):
            tag = one((half * 3 + piece) << 56)
            keys.append(tag | (kept << one(11)) | ((other >> one(shift)) & one(mask)))
    for bit in range(32):
        open_one = high & one(0xFFFFFFFF ^ (1 << bit))
        for piece, shift in enumerate((0, 16)):
            tag = one((6 + bit * 2 + piece) << 56)
            keys.append(tag | (open_one << one(16)) | ((low >> one(shift)) & one(0xFFFF)))
    return np.stack(keys, axis=1)


def _count_bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


_FLIPS = np.array(
    [1 << a for a in range(64)] + [(1 << a) | (1 << b) for a, b in combinations(range(64), 2)], dtype=np.uint64
)


def links_within(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified links between rows of equal key; rows are sorted by key."""
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    sizes = np.diff(np.concatenate([new, [len(keys)]]))
    size = np.repeat(sizes, sizes)
    left, right = [], []
    small = np.flatnonzero((size > 1) & (size <= SMALL_GROUP))
    k, f = keys[small], fps[small]
    for step in range(1, int(size[small].max(initial=1))):
        near = (k[step:] == k[:-step]) & (_count_bits(f[step:] ^ f[:-step]) <= MAX_BITS)
        left.append(f[:-step][near])
        right.append(f[step:][near])
    for start, n in zip(new[sizes > SMALL_GROUP], sizes[sizes > SMALL_GROUP], strict=True):
        members = np.unique(fps[start : start + n])
        varying = np.bitwise_or.reduce(members ^ members[0])
        for flip in _FLIPS[(_FLIPS & ~varying) == 0]:
            other = members ^ flip
            found = members[np.minimum(np.searchsorted(members, other), len(members) - 1)] == other
            found &= other > members
            left.append(members[found])
            right.append(other[found])
    if not left:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(left), np.concatenate(right)


def links(distinct: DataFrame) -> DataFrame:
    """All pairs ``(u, v)`` of the distinct fingerprints ``fp`` that differ in at most two bits."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.asarray(batch.column(0)).view(np.uint64)
            keys = signatures(fps)
            columns = [pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(fps, keys.shape[1]).view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "fp"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[tuple[np.ndarray, np.ndarray]] = []

        def linked() -> pa.RecordBatch:
            keys = np.concatenate([k for k, _ in rest])
            fps = np.concatenate([f for _, f in rest]).view(np.uint64)
            left, right = links_within(keys, fps)
            pairs = np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)], axis=1), axis=0)
            columns = [pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64)) for i in (0, 1)]
            return pa.RecordBatch.from_arrays(columns, ["u", "v"])

        size = 0
        for batch in batches:
            rest.append((np.asarray(batch.column(0)), np.asarray(batch.column(1))))
            size += len(batch)
            if size >= VERIFY_ROWS and rest[0][0][0] != rest[-1][0][-1]:
                keys, fps = (np.concatenate(x) for x in zip(*rest, strict=True))
                last = int(np.searchsorted(keys, keys[-1]))
                rest[:] = [(keys[:last], fps[:last])]
                yield linked()
                rest[:] = [(keys[last:], fps[last:])]
                size = len(keys) - last
        if size:
            yield linked()

    keyed = distinct.select("fp").mapInArrow(expand, "key bigint, fp bigint")
    grouped = keyed.repartition("key").sortWithinPartitions("key", "fp")
    return grouped.mapInArrow(verify, "u bigint, v bigint").distinct()


def _rooted(classes: DataFrame) -> DataFrame:
    """``classes`` (``fp`` and more) with the ``root`` of the component of each."""
    joined = components(links(classes.select("fp")))
    return classes.join(joined, classes["fp"] == joined["node"], "left").withColumn("root", F.coalesce("root", "fp")).drop("node")


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row."""
    marked = stored(fingerprints(docs, text), "fingerprints")
    rooted = _rooted(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row of every component: that with the smallest id, of rows with this id the one whose text has
    the smallest hash. So rows that share an id but belong to different components all stay.

    A NULL id is kept only where its component has no other id. Of rows equal in id and text one stays.
    """
    content = [F.xxhash64(F.col(text)), F.xxhash64(F.lit("again"), F.col(text))]
    identity = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id"), content[0].alias("a"), content[1].alias("b"))
    packed = docs.select(F.struct(*docs.columns).alias("__doc"), "doc_id", text, identity.alias("__who"))
    marked = stored(fingerprints(packed, text, ("__who",)), "fingerprints")
    firsts = _rooted(marked.groupBy("fp").agg(F.min("__who").alias("first"))).groupBy("root").agg(F.min("first").alias("first"))
    same = F.xxhash64(F.col("first.id").isNull(), "first.id", "first.a", "first.b")
    chosen = firsts.select("first", same.alias("__key")).distinct()
    keyed = packed.select("__doc", "__who", F.xxhash64(F.col("__who.id").isNull(), "__who.id", "__who.a", "__who.b").alias("__key"))
    kept = keyed.join(chosen, (keyed["__key"] == chosen["__key"]) & keyed["__who"].eqNullSafe(chosen["first"])).drop(chosen["__key"])
    return kept.dropDuplicates(["__key", "__who"]).select("__doc.*")
