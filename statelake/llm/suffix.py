"""Exact removal of repeated 100-byte strings, by external induced sorting of shards.

Every 100-byte window of a text has a least 24-byte string in it, its anchor; equal windows have equal
anchors at equal places. A run of windows with one anchor is a strip of at most 176 bytes, and equal
windows can only lie in strips of one anchor. So strips are dealt out by anchor:

1. every task cuts its texts into strips and keeps the first of equal ones; the others are repeats of
   an earlier text whatever else there is, and are marked right away, so a passage that a third of all
   texts share sends one strip per task;
2. strips meet by anchor, without their bytes. All but the first of equal strips are marked. Anchors
   with a single strip left are done;
3. what remains are strips that agree in part. Their bytes are fetched, and the strips of whole anchors
   are joined into shards of at most twice ``SHARD_BYTES``, whose suffix and common-prefix arrays are
   built by induced sorting in memory (its queues can go to disk). Runs of suffixes that share 100 bytes
   are equal windows; all but the first of a run are marked. An anchor with more than ``SHARD_BYTES`` of
   strips is not sorted: its windows are dealt out by their own hash, after every task has dropped its
   own copies, and meet as the strips do in step 2;
4. marked windows become byte spans of their texts, which are cut out.

A window is removed when an equal one starts earlier, in a smaller id or further ahead in the text,
judged on the input. Strips are compared by 64-bit hashes of anchor and content together, windows of
large anchors by one 64-bit hash.

Defined cases: a NULL or text below 100 bytes loses nothing; rows of one id are ordered by their place
in the table, so of repeated rows all but one lose every window; a NULL id comes first; an empty table
gives an empty result; further columns are ignored. Numbered rows are written once, so all jobs see
the same numbers whatever executors come and go.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from statelake.llm.common import fit_python, stored
from statelake.llm.induced import SPILL_BYTES, suffix_order
from statelake.llm.tokens import mixed, span_hashes, text_bytes

LENGTH = 100
ANCHOR = 24
CUT_BYTES = 8 * 1024 * 1024
CHUNK = 1 << 16
SHARD_BYTES = 4 * 1024 * 1024
STRIP, SPAN, OPEN = 0, 1, 2
FIRST_ID = -(2**63)


def anchor_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``ANCHOR`` bytes, a multiple of 8, from every place on; the last are padded with zeros."""
    padded = np.concatenate([data, np.zeros(ANCHOR, dtype=np.uint8)])
    two = padded[:-1].astype(np.uint16) | padded[1:].astype(np.uint16) << 8
    four = two[:-2].astype(np.uint32) | two[2:].astype(np.uint32) << 16
    eight = four[:-4].astype(np.uint64) | four[4:].astype(np.uint64) << np.uint64(32)
    found = np.zeros(len(data), dtype=np.uint64)
    for at in range(0, ANCHOR, 8):
        found ^= eight[at : at + len(data)]
        found *= np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(32)
    return mixed(found)


def least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` hashes the place of the least one, the leftmost of equals."""
    bits = np.uint64(max(len(hashes), 2) - 1).item().bit_length()
    low = np.uint64((1 << bits) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    return (least & low).astype(np.int64)


def strips_of(data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """All strips of texts that lie behind one another: anchor, content hash, text, start, windows.

    Works through the bytes in chunks that fit a processor's cache; a strip that may go on behind a
    chunk's end begins the next one.
    """
    parts, first, end = [], 0, len(data) - LENGTH + 1
    while first < end:
        last = min(first + CHUNK, end)
        found = _strips_between(data, at, first, last)
        first = last
        if found:
            text, start, windows = (int(found[i][-1]) for i in (2, 3, 4))
            if last < end and at[text] + start + windows == last:
                first = int(at[text]) + start
                found = tuple(x[:-1] for x in found)
            parts.append(found)
    fields = ("anchor", "content", "text", "start", "windows")
    return {k: np.concatenate([np.zeros(0, np.int64), *(p[i] for p in parts)]) for i, k in enumerate(fields)}


def _strips_between(data: np.ndarray, at: np.ndarray, first: int, last: int) -> tuple | None:
    chunk = data[first : last + LENGTH - 1]
    a, b = np.searchsorted(at, [first, last - 1], side="right") - 1
    sizes = np.diff(np.clip(at[a : b + 2], first, last))
    text = np.repeat(np.arange(a, b + 1), sizes)
    places = np.flatnonzero(np.arange(first + LENGTH, last + LENGTH) <= np.repeat(at[a + 1 : b + 2], sizes))
    if not len(places):
        return None
    hashes = anchor_hashes(chunk)
    anchor = least_places(hashes, LENGTH - ANCHOR + 1)[places]
    text = text[places]
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    windows = np.diff(np.append(new, len(places)))
    start, text = places[new], text[new]
    content = span_hashes(chunk, start, start + windows + LENGTH - 1)
    return hashes[anchor[new]].view(np.int64), content.view(np.int64), text, start + first - at[text], windows


FOUND = "anchor bigint, kind int, content bigint, ord bigint, row bigint, start int, windows int"
NAMES = [c.split()[0] for c in FOUND.split(", ")]


def _sent(kind, anchor, content, order, row, start, windows) -> pa.RecordBatch:
    n = len(row)
    columns = [
        pa.array(anchor, pa.int64()), pa.array(np.full(n, kind, dtype=np.int32)), pa.array(content, pa.int64()), pa.array(order, pa.int64()),
        pa.array(row, pa.int64()), pa.array(start.astype(np.int32)), pa.array(windows.astype(np.int32)),
    ]
    return pa.RecordBatch.from_arrays(columns, NAMES)


def _marked(row: np.ndarray, start: np.ndarray, windows: np.ndarray) -> pa.RecordBatch:
    """Spans of marked windows, those that follow one another as one."""
    order = np.lexsort((start, row))
    row, start, windows = row[order], start[order].astype(np.int64), windows[order].astype(np.int64)
    if len(row):
        new = np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] > (start + windows)[:-1])])
        first = np.flatnonzero(new)
        end = (start + windows)[np.append(first[1:], len(row)) - 1]
        row, start, windows = row[first], start[first], end - start[first]
    zero = np.zeros(len(row), dtype=np.int64)
    return _sent(SPAN, mixed(row.astype(np.uint64)).view(np.int64), zero, zero, row, start, windows)


def first_of_equals(keys: tuple, order: tuple) -> tuple[np.ndarray, np.ndarray]:
    """The first of all rows with equal ``keys``, by ``order``, and the others; the former sorted by the first key."""
    sort = np.argsort(keys[0])
    same = np.zeros(len(sort) + 1, dtype=bool)
    same[1:-1] = keys[0][sort][1:] == keys[0][sort][:-1]
    shared = same[1:] | same[:-1]
    alone, some = sort[~shared], sort[shared]
    some = some[np.lexsort([k[some] for k in (*order[::-1], *keys[::-1])])]
    again = np.zeros(len(some), dtype=bool)
    again[1:] = True
    for key in keys:
        again[1:] &= key[some][1:] == key[some][:-1]
    first = np.concatenate([alone, some[~again]])
    return first[np.argsort(keys[0][first])], some[again]


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1, over batches of row number, order and text."""
    held: list[pa.RecordBatch] = []
    size = 0

    def emit() -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(held)
        data, at = text_bytes(whole.column(2).cast(pa.large_string()).combine_chunks())
        row, order = (np.asarray(whole.column(i)) for i in (0, 1))
        s = strips_of(data, at)
        of, by = row[s["text"]], order[s["text"]]
        first, later = first_of_equals((s["anchor"], s["content"]), (by, of, s["start"]))
        yield _sent(STRIP, s["anchor"][first], s["content"][first], by[first], of[first], s["start"][first], s["windows"][first])
        yield _marked(of[later], s["start"][later], s["windows"][later])

    for batch in batches:
        held.append(batch)
        size += batch.column(2).nbytes
        if size >= CUT_BYTES:
            yield from emit()
            held, size = [], 0
    if held:
        yield from emit()


def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2, over rows sorted by anchor, kind, content and order. Only the last row is remembered,
    and the first strip of the last anchor while it may still be its only one."""
    last: tuple | None = None
    waiting: tuple | None = None

    for batch in batches:
        kind = np.asarray(batch.column(1))
        if (kind == SPAN).any():
            yield batch.filter(pa.array(kind == SPAN))
        rows = batch.filter(pa.array(kind == STRIP))
        if not len(rows):
            continue
        anchor, content, order, row, start, windows = (np.asarray(rows.column(i)) for i in (0, 2, 3, 4, 5, 6))
        before_anchor = np.concatenate([[last[0] if last else ~anchor[0]], anchor[:-1]])
        before_content = np.concatenate([[last[1] if last else 0], content[:-1]])
        same = anchor == before_anchor
        copy = same & (content == before_content)
        if copy.any():
            yield _marked(row[copy], start[copy], windows[copy])
        firsts = np.flatnonzero(~copy)
        if waiting is not None and len(firsts):
            if anchor[firsts[0]] == waiting[0]:
                yield _sent(OPEN, *(np.array([x]) for x in waiting))
            waiting = None
        if len(firsts):
            a = anchor[firsts]
            shared = np.zeros(len(firsts), dtype=bool)
            shared[1:] |= a[1:] == a[:-1]
            shared[:-1] |= a[1:] == a[:-1]
            shared |= same[firsts]
            if not shared[-1]:
                f = firsts[-1]
                waiting = (anchor[f], content[f], order[f], row[f], start[f], windows[f])
            f = firsts[shared]
            if len(f):
                yield _sent(OPEN, anchor[f], content[f], order[f], row[f], start[f], windows[f])
        last = (anchor[-1], content[-1])


def repeats_in_shard(pieces: list[bytes], windows: np.ndarray, limit: int = SPILL_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Windows of a shard that also start in an earlier piece, or earlier in theirs: piece and offset.

    Pieces come in order, each holds ``windows`` windows.
    """
    sizes = np.array([len(p) + 1 for p in pieces])
    ends = np.cumsum(sizes)
    text = np.zeros(int(ends[-1]) + 1, dtype=np.int16)
    text[:-1] = np.frombuffer(b"\0".join([*pieces, b""]), dtype=np.uint8)
    text[:-1] += 2
    text[ends - 1] = 1
    order, prefix = suffix_order(text, limit)
    group = np.cumsum(prefix < LENGTH)
    shared = np.append(prefix[1:] >= LENGTH, False) | (prefix >= LENGTH)
    order, group = order[shared], group[shared]
    piece = np.repeat(np.arange(len(pieces)), sizes)[order]
    offset = order - (ends - sizes)[piece]
    starts = offset < windows[piece]
    order, group, piece, offset = order[starts], group[starts], piece[starts], offset[starts]
    by = np.lexsort((order, group))
    later = np.zeros(len(by), dtype=bool)
    later[1:] = group[by][1:] == group[by][:-1]
    return piece[by][later], offset[by][later]


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3, over strips with their bytes, sorted by anchor and order; shards hold whole anchors."""
    held: list[tuple] = []
    size, now = 0, None

    def emit() -> pa.RecordBatch:
        # Anchors differ in the bytes they hold, so windows of different anchors never are equal.
        ranked = sorted(range(len(held)), key=lambda k: held[k][1:4])
        rows = np.array([held[k][2] for k in ranked])
        start = np.array([held[k][3] for k in ranked])
        piece, offset = repeats_in_shard([held[k][5] for k in ranked], np.array([held[k][4] for k in ranked]))
        return _marked(rows[piece], start[piece] + offset, np.ones(len(piece), dtype=np.int64))

    for batch in batches:
        for item in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            if size >= SHARD_BYTES and item[0] != now:
                yield emit()
                held, size = [], 0
            now = item[0]
            held.append(item)
            size += len(item[5])
    if held:
        yield emit()


def large_anchors(open_ones: DataFrame, most: int) -> DataFrame:
    """Anchors with more than ``most`` bytes of open strips; at most one for so many bytes."""
    size = F.sum(F.col("windows") + (LENGTH - 1))
    return open_ones.groupBy("anchor").agg(size.alias("bytes")).filter(F.col("bytes") > most).select("anchor")


def window_strips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of strips with their bytes as a strip of its own, with its hash for an anchor.

    The first of equal windows of a batch is kept, the others are marked right away.
    """
    for batch in batches:
        if not len(batch):
            continue
        order, row, start, windows = (np.asarray(batch.column(i)).astype(np.int64) for i in (1, 2, 3, 4))
        pieces = batch.column(5).to_pylist()
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        begins = np.concatenate([[0], np.cumsum([len(p) for p in pieces])[:-1]])
        of = np.repeat(np.arange(len(windows)), windows)
        offset = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = begins[of] + offset
        content = span_hashes(data, at, at + LENGTH).view(np.int64)
        by, of, start = order[of], row[of], start[of] + offset
        first, later = first_of_equals((content,), (by, of, start))
        one = np.ones(len(content), dtype=np.int64)
        yield _sent(STRIP, content[first], content[first], by[first], of[first], start[first], one[: len(first)])
        yield _marked(of[later], start[later], one[: len(later)])


def listed(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """What lists of structs hold: the row of every struct, and the fields; a NULL list is empty."""
    sizes = np.asarray(column.value_lengths().fill_null(0))
    return np.repeat(np.arange(len(column)), sizes), [np.asarray(x) for x in column.flatten().flatten()]


def removed_spans(docs: DataFrame, text: str = "text", shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """Numbered rows, and the byte spans ``(row, start, end)`` to remove, which may overlap."""
    fit_python(docs.sparkSession)
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_ID))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), order.alias("ord"), "doc_id", F.col(text).alias("text"))
    numbered = stored(rows, "numbered", "zstd")
    strips = numbered.select("row", "ord", "text").mapInArrow(cut, FOUND)
    sorted_strips = strips.repartition("anchor").sortWithinPartitions("anchor", "kind", "content", "ord", "row", "start")
    met = stored(sorted_strips.mapInArrow(meet, FOUND), "strips")
    open_ones = met.filter(F.col("kind") == OPEN)
    large = stored(large_anchors(open_ones, shard_bytes), "large-anchors")

    piece = "anchor bigint, ord bigint, row bigint, start int, windows int, data binary"
    names = [c.split()[0] for c in piece.split(", ")]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(2).cast(pa.large_string()))
            of, (anchor, start, windows) = listed(batch.column(3))
            first = at[of] + start
            raw = data.tobytes()
            found = [raw[a:b] for a, b in zip(first.tolist(), (first + windows + LENGTH - 1).tolist(), strict=True)]
            row, by = (np.asarray(batch.column(i))[of] for i in (0, 1))
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in (anchor, by, row, start, windows)), pa.array(found, pa.binary())], names)

    def pieces(strips: DataFrame) -> DataFrame:
        wanted = strips.groupBy("row").agg(F.collect_list(F.struct("anchor", "start", "windows")).alias("strips"))
        return numbered.join(wanted, "row").select("row", "ord", "text", "strips").mapInArrow(fetch, piece)

    some = not large.isEmpty()
    small = open_ones.join(F.broadcast(large), "anchor", "left_anti") if some else open_ones
    dealt = pieces(small).repartition("anchor").sortWithinPartitions("anchor", "ord", "row", "start")
    spans = met.filter(F.col("kind") == SPAN).unionByName(dealt.mapInArrow(shards, FOUND))
    if some:
        own = pieces(open_ones.join(F.broadcast(large), "anchor", "left_semi")).mapInArrow(window_strips, FOUND)
        sorted_windows = own.repartition("anchor").sortWithinPartitions("anchor", "kind", "content", "ord", "row", "start")
        spans = spans.unionByName(sorted_windows.mapInArrow(meet, FOUND).filter(F.col("kind") == SPAN))
    end = F.col("start") + F.col("windows") + (LENGTH - 1)
    return numbered, spans.select("row", "start", end.alias("end"))


def joined(row: np.ndarray, spans: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans that overlap or follow one another as one: row, start and end, in order."""
    start, end = (x.astype(np.int64) for x in spans)
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    if not len(row):
        return row, start, end
    apart = row * (int(end.max()) + 1)
    reached = np.maximum.accumulate(apart + end)
    new = np.concatenate([[True], (row[1:] != row[:-1]) | ((apart + start)[1:] > reached[:-1])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    return row[first], start[first], reached[last] - apart[last]


def without_repeats(docs: DataFrame, text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Every row with its size, the removed bytes and spans, the digest and bytes of what is kept."""
    numbered, spans = removed_spans(docs, text, shard_bytes)
    per_row = spans.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    made = StructType.fromDDL("n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    result = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *made.fields])
    names = result.names

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(1).cast(pa.large_string()))
            n_bytes = np.diff(at)
            row, first, last = joined(*listed(batch.column(2)))
            removed, runs = np.zeros(len(batch), dtype=np.int64), np.bincount(row, minlength=len(batch))
            np.add.at(removed, row, last - first)
            inside = np.ones(len(data), dtype=bool)
            for a, b in zip((at[row] + first).tolist(), (at[row] + last).tolist(), strict=True):
                inside[a:b] = False
            bounds = np.append(0, np.cumsum(n_bytes - removed))
            left = data[inside].tobytes()
            kept = [left[a:b] for a, b in itertools.pairwise(bounds.tolist())]
            digests = pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())
            columns = [pa.array(x, pa.int64()) for x in (n_bytes, removed, runs)] + [digests, pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return numbered.join(per_row, "row", "left").select("doc_id", "text", "spans").mapInArrow(remove, result)
