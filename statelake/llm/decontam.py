"""Benchmark decontamination with an FM-index over every shard of the training texts.

Texts are read in shards of about a million words. A shard's words become symbols of an alphabet:
the words of the benchmark block, and one separator for everything else; runs too short to hold any
phrase are left out, as no phrase can occur there. Over what remains the shard builds a suffix array,
its Burrows-Wheeler transform as a wavelet matrix with rank counts, and a sample of suffix positions.
All phrases of the block are searched backwards together; hits are located from the sampled positions
and merged into removal spans. Nothing is shuffled, and no shard depends on another.

The benchmark is a stated query set. It is cut into blocks of bounded size, each block is broadcast
and searched in every shard; with several blocks the spans of a row are merged afterwards.

Words are compared by 64-bit hashes. Defined cases: a NULL or empty text has no words and no hits; an
item without words has no phrases; a NULL item id marks hits but is not listed; two items with one id
count once; repeated rows are judged each for itself; an empty benchmark leaves every document clean;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from statelake.llm.common import fit_python, stored
from statelake.llm.tokens import ALPHANUMERIC, word_hashes

PHRASE = 13
SHARD_WORDS = 1 << 20
BLOCK_WORDS = 1 << 20
SAMPLE = 8
SPANS = "array<struct<start:bigint,end:bigint>>"


# ---------------------------------------------------------------------------------------------------
# the index


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order, by doubling ranks. Zeros are separators, each unique."""
    n = len(symbols)
    rank = symbols.astype(np.int64)
    gaps = np.flatnonzero(symbols == 0)
    rank += len(gaps)
    rank[gaps] = np.arange(len(gaps) - 1, -1, -1)
    order = np.argsort(rank, kind="stable")
    step = 0
    while True:
        ordered = rank[order]
        if step:
            ahead = np.where(order + step < n, rank[np.minimum(order + step, n - 1)] + 1, 0)
            fresh = np.concatenate([[True], (ordered[1:] != ordered[:-1]) | (ahead[1:] != ahead[:-1])])
        else:
            fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        place = np.cumsum(fresh) - 1
        rank = np.empty(n, dtype=np.int64)
        rank[order] = place
        if place[-1] == n - 1:
            return order
        step = step * 2 or 1
        ahead = np.zeros(n, dtype=np.int64)
        ahead[:-step] = rank[step:] + 1
        order = np.argsort(rank * (n + 1) + ahead, kind="stable")


@dataclass
class WaveletMatrix:
    """Rank counts over a sequence of symbols, one bit level at a time."""

    levels: list[tuple[np.ndarray, int]] = field(default_factory=list)
    depth: int = 0

    @classmethod
    def of(cls, symbols: np.ndarray, depth: int) -> WaveletMatrix:
        made = cls(depth=depth)
        for level in range(depth - 1, -1, -1):
            zero = (symbols >> level) & 1 == 0
            counts = np.zeros(len(symbols) + 1, dtype=np.int32)
            np.cumsum(zero, out=counts[1:])
            made.levels.append((counts, int(counts[-1])))
            symbols = np.concatenate([symbols[zero], symbols[~zero]])
        return made

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each ``symbol`` occurs before each position ``at``."""
        first = np.zeros_like(at)
        for k, (zeros, total) in enumerate(self.levels):
            bit = (symbol >> (self.depth - 1 - k)) & 1 == 1
            z_at, z_first = zeros[at], zeros[first]
            at = np.where(bit, total + at - z_at, z_at)
            first = np.where(bit, total + first - z_first, z_first)
        return at - first


@dataclass
class FMIndex:
    """Backward search over one shard; symbol 0 is the separator, the last symbol is one."""

    bwt: np.ndarray
    matrix: WaveletMatrix
    below: np.ndarray
    sampled: np.ndarray
    samples: np.ndarray

    @classmethod
    def of(cls, symbols: np.ndarray, alphabet: int) -> FMIndex:
        order = suffix_array(symbols)
        bwt = symbols[order - 1]
        below = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=alphabet))])
        keep = (order % SAMPLE == 0) | (bwt == 0)
        return cls(
            bwt, WaveletMatrix.of(bwt, max(1, (alphabet - 1).bit_length())), below,
            np.concatenate([[0], np.cumsum(keep)]), order[keep],
        )

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For phrases of one length, as rows: first and last-plus-one suffix of each range."""
        lo = np.zeros(len(phrases), dtype=np.int64)
        hi = np.full(len(phrases), len(self.bwt), dtype=np.int64)
        alive = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, column]
            lo[alive] = self.below[symbol] + self.matrix.rank(symbol, lo[alive])
            hi[alive] = self.below[symbol] + self.matrix.rank(symbol, hi[alive])
            alive = alive[lo[alive] < hi[alive]]
            if not len(alive):
                break
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, walking back to the nearest sampled one."""
        at, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        open_ones = np.arange(len(rows))
        while True:
            here = at[open_ones]
            known = self.sampled[here + 1] > self.sampled[here]
            open_ones = open_ones[~known]
            if not len(open_ones):
                return self.samples[self.sampled[at]] + steps
            here = at[open_ones]
            symbol = self.bwt[here]
            at[open_ones] = self.below[symbol] + self.matrix.rank(symbol, here)
            steps[open_ones] += 1


# ---------------------------------------------------------------------------------------------------
# phrases of the benchmark


@dataclass
class Block:
    """The phrases of some items: alphabet, phrases by length, and the items of each phrase."""

    vocabulary: np.ndarray
    phrases: list[np.ndarray]
    owners: list[tuple[np.ndarray, np.ndarray]]
    names: list[str]
    shortest: int

    @classmethod
    def of(cls, names: list[str | None], texts: list[str | None]) -> Block:
        hashes, rows = word_hashes(pa.array(texts, pa.string()), ALPHANUMERIC)
        vocabulary, symbols = np.unique(hashes, return_inverse=True)
        symbols = symbols.astype(np.int64) + 1
        known = sorted({n for n in names if n is not None})
        number = {n: i for i, n in enumerate(known)} | {None: -1}
        by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
        for i, name in enumerate(names):
            own = symbols[rows[i] : rows[i + 1]]
            if len(own):
                length = min(PHRASE, len(own))
                windows = np.lib.stride_tricks.sliding_window_view(own, length)
                by_length.setdefault(length, []).append((windows, number[name]))
        phrases, owners = [], []
        for length in sorted(by_length):
            windows = np.concatenate([w for w, _ in by_length[length]])
            items = np.concatenate([np.full(len(w), k) for w, k in by_length[length]])
            distinct, of = np.unique(windows, axis=0, return_inverse=True)
            pairs = np.unique(np.stack([of.reshape(-1), items], axis=1), axis=0)
            phrases.append(distinct)
            owners.append((np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1)), pairs[:, 1]))
        return cls(vocabulary, phrases, owners, known, min(by_length, default=PHRASE))


def blocks_of(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> Iterator[Block]:
    """The benchmark in blocks; the driver holds one block at a time."""
    names, texts, size = [], [], 0
    for row in benchmark.select(F.col(item).cast("string"), text).toLocalIterator():
        names.append(row[0])
        texts.append(row[1])
        size += len(row[1] or "") // 4
        if size >= BLOCK_WORDS:
            yield Block.of(names, texts)
            names, texts, size = [], [], 0
    if names:
        yield Block.of(names, texts)


# ---------------------------------------------------------------------------------------------------
# search


def search_shard(hashes: np.ndarray, rows: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Which words of a shard are hit, and the distinct pairs (row, item) of it."""
    hit = np.zeros(len(hashes) + 1, dtype=np.int64)
    nothing = np.zeros((0, 2), dtype=np.int64)
    if not len(hashes) or not len(block.vocabulary):
        return hit[:-1] > 0, nothing
    at = np.minimum(np.searchsorted(block.vocabulary, hashes), len(block.vocabulary) - 1)
    symbols = np.where(block.vocabulary[at] == hashes, at + 1, 0)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    new_run = np.concatenate([[True], (row[1:] != row[:-1]) | (symbols[1:] == 0) | (symbols[:-1] == 0)])
    run = np.cumsum(new_run) - 1
    lengths = np.bincount(run)
    kept = np.flatnonzero((symbols > 0) & (lengths[run] >= block.shortest))
    if not len(kept):
        return hit[:-1] > 0, nothing
    # One separator after every run: the word after the last one of a run has another run number.
    ends = np.flatnonzero(np.concatenate([run[kept][1:] != run[kept][:-1], [True]])) + 1
    text = np.insert(symbols[kept], ends, 0)
    place = np.insert(kept, ends, -1)
    index = FMIndex.of(text, len(block.vocabulary) + 1)
    found = []
    for phrases, (first, items) in zip(block.phrases, block.owners, strict=True):
        lo, hi = index.search(phrases)
        counts = hi - lo
        which = np.repeat(np.arange(len(phrases)), counts)
        if not len(which):
            continue
        suffixes = np.repeat(lo, counts) + np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = place[index.locate(suffixes)]
        np.add.at(hit, starts, 1)
        np.add.at(hit, starts + phrases.shape[1], -1)
        pairs = np.unique(np.stack([row[starts], which], axis=1), axis=0)
        times = first[pairs[:, 1] + 1] - first[pairs[:, 1]]
        offset = np.repeat(first[pairs[:, 1]], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        found.append(np.stack([np.repeat(pairs[:, 0], times), items[offset]], axis=1))
    pairs = np.unique(np.concatenate(found), axis=0) if found else nothing
    return np.cumsum(hit[:-1]) > 0, pairs[pairs[:, 1] >= 0]


def _result(carried: list[pa.Array], hashes: np.ndarray, rows: np.ndarray, block: Block, names: list[str]) -> pa.RecordBatch:
    hit, pairs = search_shard(hashes, rows, block)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    edge = np.concatenate([[True], row[1:] != row[:-1]]) if len(row) else np.zeros(0, bool)
    before = np.concatenate([[False], hit[:-1]]) & ~edge if len(row) else hit
    after = np.concatenate([hit[1:], [False]]) & ~np.concatenate([edge[1:], [True]]) if len(row) else hit
    starts, ends = np.flatnonzero(hit & ~before), np.flatnonzero(hit & ~after) + 1
    base = rows[row[starts]]
    spans = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(starts, rows).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(starts - base), pa.array(ends - base)], ["start", "end"]),
    )
    items = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(pairs[:, 0], np.arange(len(rows))).astype(np.int32)),
        pa.array([block.names[k] for k in pairs[:, 1]], pa.string()),
    )
    return pa.RecordBatch.from_arrays([*carried, pa.array(np.diff(rows)), spans, items], names)


def marked(docs: DataFrame, shared: Broadcast[Block], carry: list[str], text: str = "text") -> DataFrame:
    """Every row of ``docs``: ``carry``, ``n_words``, and the spans and items found of one block."""
    fit_python(docs.sparkSession)
    names = [*carry, "n_words", "removal_spans", "items"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def shard() -> pa.RecordBatch:
            hashes = np.concatenate([h for h, _ in parts])
            starts = np.cumsum([0, *[len(h) for h, _ in parts]])
            rows = np.concatenate([[0], *[r[1:] + s for (_, r), s in zip(parts, starts, strict=False)]])
            carried = [pa.concat_arrays([b.column(i) for b in held]) for i in range(len(carry))]
            return _result(carried, hashes, rows, shared.value, names)

        for batch in batches:
            parts.append(word_hashes(batch.column(len(carry)), ALPHANUMERIC))
            held.append(batch.select(list(range(len(carry)))))
            size += len(parts[-1][0])
            if size >= SHARD_WORDS:
                yield shard()
                held, parts, size = [], [], 0
        if held:
            yield shard()

    found = StructType.fromDDL(f"n_words bigint, removal_spans {SPANS}, items array<string>")
    schema = StructType([docs.schema[c] for c in carry] + found.fields)
    return docs.select(*carry, text).mapInArrow(run, schema)


def _merged(spans) -> object:
    """Overlapping or touching spans of a sorted array made one."""
    start = F.array().cast(SPANS)

    def step(acc, s):
        last = F.element_at(acc, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        joins = (F.size(acc) > 0) & (s["start"] <= F.try_element_at(acc, F.lit(-1))["end"])
        return F.when(joins, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(longer))).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(F.array_sort(spans), start, step)


def contamination(docs: DataFrame, benchmark: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """Every row of ``docs`` with its words, hits, items, removal spans and the verdict.

    Blocks are searched one after the other: what a block finds is written and its broadcast taken
    back before the next one is made, so driver and workers hold two blocks at most.
    """
    spread = docs.sparkSession.sparkContext.broadcast
    blocks = blocks_of(benchmark)
    first = next(blocks, None)
    second = next(blocks, None) if first else None
    if second is None:
        found = marked(docs, spread(first or Block.of([], [])), carry, text)
    else:
        numbered = stored(docs.select(F.monotonically_increasing_id().alias("__row"), *carry, text), "numbered")

        def searched(block: Block, kept: list[str]) -> DataFrame:
            shared = spread(block)
            result = stored(marked(numbered, shared, kept, text).filter(F.lit(len(kept) > 1) | (F.size("removal_spans") > 0)), "block")
            shared.destroy()
            return result

        found = searched(first, ["__row", *carry])
        first = None
        every = found.select("__row", "removal_spans", "items").filter(F.size("removal_spans") > 0)
        while second is not None:
            every = every.unionByName(searched(second, ["__row"]).select("__row", "removal_spans", "items"))
            second = next(blocks, None)
        merged = every.groupBy("__row").agg(
            _merged(F.flatten(F.collect_list("removal_spans"))).alias("removal_spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        )
        nothing = {"removal_spans": F.array().cast(SPANS), "items": F.array().cast("array<string>")}
        found = found.drop("removal_spans", "items").join(merged, "__row", "left").drop("__row")
        found = found.withColumns({c: F.coalesce(c, v) for c, v in nothing.items()})
    lengths = F.transform("removal_spans", lambda s: s["end"] - s["start"])
    return found.select(
        *carry,
        "n_words",
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        "removal_spans",
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
