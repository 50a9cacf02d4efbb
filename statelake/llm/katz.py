"""Language-model scores by Katz backoff.

The model is a bigram model over all training words. Unigram and bigram counts up to five get
Good-Turing discounts; what the discounts free goes to words never seen, and for every context to the
followers never seen after it, through a backoff weight that makes the distribution of every context
sum to one. A text is scored word by word, from the bigram where it was counted, else through the
backoff weight of its context from the unigram, else from the class of unseen words.

Scale: words and bigrams above a count threshold, picked so that their number is bounded, travel by
broadcast and are looked up where the text lies. All others, each of which holds a small share of the
corpus by construction, are exchanged with the counts and contexts they need, packed into sorted
blocks. The two bounds decide only by which way a count travels, never what it is. A frequent word is
coded by its place among them, any other by its hash. Bigrams of frequent contexts are dealt by both
words, those of other contexts by the context, so that these meet its total and backoff weight.

Defined cases: a NULL or empty text consists of its end alone; a NULL id counts as empty text in the
choice of held-out rows; repeated rows are scored each for itself and count each in training; without
training rows every probability is that of the unseen class (one); an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from statelake.llm.common import fit_python, stored
from statelake.llm.tokens import NOT_SPACE, mixed, word_hashes

END = np.uint64(0x656E642D6F662D74)  # stands for the end of a text among the word hashes
DISCOUNTED = 5
FLUSH_TOKENS = 500_000
BLOCK = "part int, kind int, from_row bigint, data binary"
PAIR_COUNTS, CONTEXTS, PAIRS_TRAINED, PAIRS_HELD = 0, 1, 2, 3
# Held-out words of a bigram that is scored already are only counted, the others bring their probability.
WORDS_TRAINED, WORDS_COUNTED, WORDS_HELD = 4, 5, 6


@dataclass(frozen=True)
class KatzRules:
    """``frequent`` bounds the broadcast words, ``hot`` the broadcast bigrams, ``part_tokens`` sizes a part."""

    frequent: int = 1 << 19
    hot: int = 1 << 19
    part_tokens: int = 1_500_000


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


# ---------------------------------------------------------------------------------------------------
# blocks: sorted numbers, packed


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one length; the first is sorted and stored as differences."""
    first = np.diff(columns[0].astype(np.uint64), prepend=np.uint64(0))
    planes = [first.view(np.uint8).reshape(-1, 8).T]
    planes += [c.astype(np.uint32).view(np.uint8).reshape(-1, 4).T for c in columns[1:]]
    raw = b"".join(np.ascontiguousarray(p).tobytes() for p in planes)
    return len(columns[0]).to_bytes(4, "little") + zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(data: bytes) -> list[np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[4:]), dtype=np.uint8)
    first = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view(np.uint64).reshape(-1)
    rest = raw[8 * n :].reshape(-1, 4, n) if n else np.zeros((0, 4, 0), np.uint8)
    return [np.cumsum(first, dtype=np.uint64), *(np.ascontiguousarray(p.T).view(np.uint32).reshape(-1).astype(np.int64) for p in rest)]


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with their number or the sum of their weights."""
    if weights is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(weights, first) if len(first) else weights


def halves(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of 64 bits as two columns of a block."""
    bits = values.view(np.uint64)
    return bits & np.uint64(0xFFFFFFFF), bits >> np.uint64(32)


def whole(low: np.ndarray, high: np.ndarray, kind: type = np.uint64) -> np.ndarray:
    return (low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)).view(kind)


def pair_keys(contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A hash of every bigram, from the codes of its words."""
    return mixed(mixed(contexts + np.uint64(0x9E3779B97F4A7C15)) ^ words * np.uint64(0xD6E8FEB86659FD93))


def _blocks(kind: int, parts: int, base: int, keys: np.ndarray, *columns: np.ndarray, deal: np.ndarray | None = None) -> list[tuple]:
    """Rows of ``BLOCK``; dealt to parts by a scramble of ``keys``, or of ``deal``."""
    part = (mixed(keys if deal is None else deal) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((keys, part))
    part, keys = part[order], keys[order]
    columns = tuple(c[order] for c in columns)
    bounds = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else [0]
    return [
        (int(part[a]), kind, base, pack(keys[a:b], *(c[a:b] for c in columns)))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True)
    ]


def _pair_blocks(kind: int, parts: int, base: int, width: int, contexts: np.ndarray, words: np.ndarray, *columns: np.ndarray) -> list[tuple]:
    deal = np.where(contexts < np.uint64(width), pair_keys(contexts, words), contexts)
    return _blocks(kind, parts, base, contexts, *halves(words), *columns, deal=deal)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)


BLOCK_ARROW = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("from_row", pa.int64()), ("data", pa.binary())])


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of a column, every text closed by ``END``, and the first token of each."""
    words, rows = word_hashes(column, NOT_SPACE)
    return np.insert(words, rows[1:], END), rows + np.arange(len(rows))


# ---------------------------------------------------------------------------------------------------
# counts


def discounts(n: list[int]) -> list[float]:
    """Good-Turing factors of counts 1 to 5 from the numbers of things seen 1 to 6 times.

    Where the estimate is not a proper discount (too little data) half an occurrence is taken off.
    """
    k = DISCOUNTED
    tail = (k + 1) * n[k] / n[0] if n[0] else 0.0
    result = []
    for r in range(1, k + 1):
        factor = 0.0
        if n[r - 1] and tail < 1:
            factor = ((r + 1) * n[r] / (r * n[r - 1]) - tail) / (1 - tail)
        result.append(factor if 0 < factor < 1 else (r - 0.5) / r)
    return result


def factor_of(count: np.ndarray, factors: list[float]) -> np.ndarray:
    return np.concatenate([[0.0], factors, [1.0]])[np.minimum(count, DISCOUNTED + 1)]


def unigram_counts(train: DataFrame, text: str = "text") -> DataFrame:
    """``(word, count)`` over all training texts; each task sends a word once per few million tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def emit() -> pa.RecordBatch:
            words, counts = counted(np.concatenate(held))
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["word", "count"])

        for batch in batches:
            held.append(tokens_of(batch.column(0))[0])
            size += len(held[-1])
            if size >= FLUSH_TOKENS:
                yield emit()
                held, size = [], 0
        if held:
            yield emit()

    parts = train.select(text).mapInArrow(run, "word bigint, count bigint")
    return parts.groupBy("word").agg(F.sum("count").alias("count"))


def threshold(histogram: DataFrame, most: int) -> int:
    """The least count that at most ``most`` things reach; ``histogram`` has ``count`` and ``things``."""
    level, total = 0, 0
    for row in histogram.orderBy(F.desc("count")).limit(most + 1).collect():
        total += row["things"]
        if total > most:
            return level or row["count"] + 1
        level = row["count"]
    return level or 1


@dataclass
class Unigrams:
    """Frequent words by hash, and what turns any count into a probability."""

    words: np.ndarray
    counts: np.ndarray
    total: int
    types: int
    factors: list[float]
    unseen: float
    scale: float

    @property
    def width(self) -> int:
        """The codes below it are those of the frequent words."""
        return len(self.words)

    def codes(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return tokens
        at = np.minimum(np.searchsorted(self.words, tokens), len(self.words) - 1)
        return np.where(self.words[at] == tokens, at.astype(np.uint64), tokens)

    def probability(self, counts: np.ndarray) -> np.ndarray:
        """The unigram probability of words of these counts; the unseen word has count zero."""
        if not self.total:
            return np.ones(len(counts))
        seen = self.scale * factor_of(counts, self.factors) * counts / self.total
        return np.where(counts > 0, seen, self.unseen)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.total + 0.1 * (self.types + 1)))


def unigrams(table: DataFrame, rules: KatzRules) -> Unigrams:
    few = [F.count_if(F.col("count") == r).alias(f"n{r}") for r in range(1, DISCOUNTED + 2)]
    row = table.agg(F.sum("count").alias("total"), F.count("*").alias("types"), *few).first()
    total, types, n = row["total"] or 0, row["types"], [row[f"n{r}"] for r in range(1, DISCOUNTED + 2)]
    least = threshold(table.groupBy("count").agg(F.count("*").alias("things")), rules.frequent)
    found = table.filter(F.col("count") >= least).toArrow()
    words = np.asarray(found["word"]).view(np.uint64) if found.num_rows else np.zeros(0, np.uint64)
    order = np.argsort(words)
    counts = np.asarray(found["count"])[order] if found.num_rows else np.zeros(0, np.int64)
    factors = discounts(n)
    seen = 1.0 - sum(n[r - 1] * r * (1 - factors[r - 1]) for r in range(1, DISCOUNTED + 1)) / total if total else 0.0
    unseen = max(1.0 - seen, 1.0 / (total + 1))
    return Unigrams(words[order], counts, total, types, factors, unseen, (1.0 - unseen) / seen if seen else 1.0)


def bigrams_of(tokens: np.ndarray, rows: np.ndarray, model: Unigrams) -> tuple[np.ndarray, np.ndarray]:
    """The codes of all tokens, and the code before each (an end before the first)."""
    codes = model.codes(tokens)
    before = np.empty_like(codes)
    before[1:] = codes[:-1]
    before[rows[:-1]] = model.codes(np.array([END]))[0]
    return before, codes


def bigram_counts(train: DataFrame, shared, parts: int, text: str = "text") -> DataFrame:
    """``(context, word, count)`` of all training bigrams, by the codes of their words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def emit() -> pa.RecordBatch:
            before, codes = (np.concatenate(x) for x in zip(*held, strict=True))
            _, first, counts = np.unique(pair_keys(before, codes), return_index=True, return_counts=True)
            return _batch(_pair_blocks(PAIR_COUNTS, parts, 0, shared.value.width, before[first], codes[first], counts), BLOCK_ARROW)

        for batch in batches:
            held.append(bigrams_of(*tokens_of(batch.column(0)), shared.value))
            size += len(held[-1][0])
            if size >= FLUSH_TOKENS:
                yield emit()
                held, size = [], 0
        if held:
            yield emit()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blocks in by_part(batches):
            loaded = []
            while blocks:
                before, low, high, counts = unpack(blocks.pop()[2])
                loaded.append((before, whole(low, high), counts.astype(np.uint32)))
            before, codes, counts = (np.concatenate(x) for x in zip(*loaded, strict=True))
            del loaded
            order = np.lexsort((codes, before))
            before, codes, counts = before[order], codes[order], counts[order]
            del order
            first = np.flatnonzero(np.concatenate([[True], (before[1:] != before[:-1]) | (codes[1:] != codes[:-1])]))
            columns = [before[first].view(np.int64), codes[first].view(np.int64), np.add.reduceat(counts, first, dtype=np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["context", "word", "count"])

    blocks = train.select(text).mapInArrow(count, BLOCK)
    return blocks.repartition("part").sortWithinPartitions("part").mapInArrow(merge, "context bigint, word bigint, count bigint")


def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, int, bytes]]]]:
    """Blocks of one part at a time, from rows sorted by part."""
    now, held = None, []
    for batch in batches:
        for part, kind, base, data in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if part != now:
                if held:
                    yield now, held
                now, held = part, []
            held.append((kind, base, data))
    if held:
        yield now, held


@dataclass
class Backoff:
    """Per frequent context: its count, the scale of its counted followers, and its backoff weight."""

    counts: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    factors: list[float]

    def seen(self, counts: np.ndarray, totals: np.ndarray, scale: np.ndarray) -> np.ndarray:
        """The probability of bigrams of these counts in contexts of these totals and scales."""
        return scale * factor_of(counts, self.factors) * counts / np.maximum(totals, 1)


def backed_off(total: np.ndarray, kept: np.ndarray, followers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scale and backoff weight of contexts, from their count, what discounts leave of it, and the mass of their followers."""
    free, rest = 1.0 - kept / total, 1.0 - followers
    everything = rest <= 1e-9
    none = ~everything & (free <= 1e-12)
    scale = np.where(everything, total / kept, np.where(none, total / (total + 1), 1.0))
    free = np.where(none, 1.0 / (total + 1), free)
    return scale, np.where(everything, 0.0, free / np.where(everything, 1.0, rest))


def is_frequent(code: Column, width: int) -> Column:
    return (code >= 0) & (code < width)


def discounted(count: Column, factors: list[float]) -> Column:
    factor = F.lit(1.0)
    for r, f in enumerate(factors, 1):
        factor = F.when(count == r, f).otherwise(factor)
    return factor * count


def rare_followers(bigrams: DataFrame, table: DataFrame, model: Unigrams) -> DataFrame:
    """The bigrams that end in a word that is not frequent, with its count as ``word_count``."""
    least = int(model.counts.min()) if model.width else None
    rare = table.filter(F.col("count") < least) if least else table
    pairs = bigrams.filter(~is_frequent(F.col("word"), model.width))
    return pairs.join(rare.withColumnRenamed("count", "word_count"), "word").select("context", "word", "count", "word_count")


def context_sums(bigrams: DataFrame, rare: DataFrame, model: Unigrams, factors: list[float]) -> DataFrame:
    """``(context, count, kept, mass)`` of every context: its count, what the discounts leave of it,
    and the unigram probability of all its followers together."""
    frequent = pa.table({"word": pa.array(np.arange(model.width)), "mass": pa.array(model.probability(model.counts))})
    mass = F.broadcast(bigrams.sparkSession.createDataFrame(frequent))
    own = bigrams.join(mass, "word", "left").select(
        "context", "count", discounted(F.col("count"), factors).alias("kept"), F.coalesce("mass", F.lit(0.0)).alias("mass")
    )
    probability = discounted(F.col("word_count"), model.factors) * (model.scale / max(model.total, 1))
    more = rare.select("context", F.lit(0).cast("long").alias("count"), F.lit(0.0).alias("kept"), probability.alias("mass"))
    return own.unionByName(more).groupBy("context").agg(*[F.sum(c).alias(c) for c in ("count", "kept", "mass")])


def backoff(sums: DataFrame, model: Unigrams, factors: list[float]) -> Backoff:
    """Of the frequent contexts, whose number is bounded."""
    found = sums.filter(is_frequent(F.col("context"), model.width)).toArrow()
    counts, scale, weight = np.zeros(model.width, np.int64), np.ones(model.width), np.ones(model.width)
    if found.num_rows:
        at = np.asarray(found["context"])
        counts[at] = np.asarray(found["count"])
        scale[at], weight[at] = backed_off(*(np.asarray(found[c]).astype(float) for c in ("count", "kept", "mass")))
    return Backoff(counts, scale, weight, factors)


# ---------------------------------------------------------------------------------------------------
# scores


def scored(docs: DataFrame, rules: KatzRules = KatzRules(), text: str = "text") -> DataFrame:
    """One row per document with its token counts, the base score and the score of the model."""
    spark = docs.sparkSession
    fit_python(spark)
    train = docs.filter(~held_out(F.col("doc_id")))
    table = stored(unigram_counts(train, text), "unigrams")
    model = unigrams(table, rules)
    width = model.width
    shared = spark.sparkContext.broadcast(model)
    parts = max(1, math.ceil(model.total / rules.part_tokens))
    bigrams = stored(bigram_counts(train, shared, parts, text), "bigrams")
    few = [F.count_if(F.col("count") == r).alias(f"n{r}") for r in range(1, DISCOUNTED + 2)]
    factors = discounts(list(bigrams.agg(*few).first()))
    rare = stored(rare_followers(bigrams, table, model), "rare-followers")
    contexts = stored(context_sums(bigrams, rare, model, factors), "contexts")
    weights = backoff(contexts, model, factors)
    least = threshold(bigrams.groupBy("count").agg(F.count("*").alias("things")), rules.hot)
    is_hot = is_frequent(F.col("context"), width) & (F.col("count") >= least)
    found = bigrams.filter(is_hot).toArrow()
    before, after, counts = (np.asarray(found[c]) if found.num_rows else np.zeros(0, np.int64) for c in ("context", "word", "count"))
    hot_keys = pair_keys(before.view(np.uint64), after.view(np.uint64))
    order = np.argsort(hot_keys)
    hot_logs = np.log10(weights.seen(counts, weights.counts[before], weights.scale[before]))
    lookup = spark.sparkContext.broadcast((weights, hot_keys[order], hot_logs[order]))

    found = StructType.fromDDL("__row bigint, n_tokens bigint, n_known bigint, base double, score double")
    made = StructType([found["__row"], docs.schema["doc_id"], *found.fields[1:]])
    sent = StructType(StructType.fromDDL(BLOCK).fields + made.fields)

    def cold_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in gathered(batches):
            before, after = held[0].view(np.uint64), held[1].view(np.uint64)
            yield _batch(_pair_blocks(PAIR_COUNTS, parts, 0, width, before, after, *held[2:]), BLOCK_ARROW)

    def cold_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for context, total, kept, mass in gathered(batches):
            scale, weight = backed_off(total.astype(float), kept, mass)
            yield _batch(_blocks(CONTEXTS, parts, 0, context.view(np.uint64), total, *halves(scale), *halves(weight)), BLOCK_ARROW)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Scores what the broadcast tables answer; all else leaves as blocks and is scored in its part."""
        words, (_, hot_keys, hot_logs) = shared.value, lookup.value
        counts = np.append(words.counts, 0)
        open_ones: dict[int, list] = {k: [] for k in (PAIRS_TRAINED, PAIRS_HELD, WORDS_TRAINED, WORDS_COUNTED, WORDS_HELD)}
        base = size = 0
        empty: list = []

        def flush() -> Iterator[pa.RecordBatch]:
            for kind, held in open_ones.items():
                if held:
                    columns = [np.concatenate(x) for x in zip(*held, strict=True)]
                    paired = kind in (PAIRS_TRAINED, PAIRS_HELD)
                    rows = _pair_blocks(kind, parts, base, width, *columns) if paired else _blocks(kind, parts, base, *columns)
                    blocks = _batch(rows, BLOCK_ARROW)
                    yield pa.RecordBatch.from_arrays([*blocks.columns, *(pa.nulls(len(rows), k) for k in empty)], sent.names)
                    held.clear()

        for batch in batches:
            ids, held_rows = np.asarray(batch.column(0)), batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            tokens, starts = tokens_of(batch.column(3))
            n = np.diff(starts)
            row, out = np.repeat(ids, n), np.repeat(held_rows, n)
            before, codes = bigrams_of(tokens, starts, words)
            frequent = codes < np.uint64(width)
            log_base = np.where(frequent, words.base(counts[np.where(frequent, codes, np.uint64(width)).astype(np.int64)]), 0.0)
            log_pair = np.zeros(len(codes))
            known = np.zeros(len(codes), dtype=bool)
            if len(hot_keys):
                pairs = pair_keys(before, codes)
                at = np.minimum(np.searchsorted(hot_keys, pairs), len(hot_keys) - 1)
                known = hot_keys[at] == pairs
                log_pair[known] = hot_logs[at[known]]
            if not size:
                base = int(ids[0])
            for kind, keys, chosen in (
                (PAIRS_TRAINED, (before, codes), ~known & ~out), (PAIRS_HELD, (before, codes), ~known & out),
                (WORDS_TRAINED, (tokens,), ~frequent & ~out),
                (WORDS_COUNTED, (tokens,), ~frequent & out & known), (WORDS_HELD, (tokens,), ~frequent & out & ~known),
            ):
                open_ones[kind].append((*(k[chosen] for k in keys), row[chosen] - base))
                size += int(chosen.sum())
            sums = [np.add.reduceat(x, starts[:-1]) for x in (frequent.astype(np.int64), log_base, log_pair)]
            columns = [batch.column(0), batch.column(1), pa.array(n), *(pa.array(x) for x in sums)]
            empty = [c.type for c in columns]
            part = pa.array((mixed(ids.astype(np.uint64)) % np.uint64(parts)).astype(np.int32))
            sender = pa.array(np.full(len(n), base))
            yield pa.RecordBatch.from_arrays([part, pa.nulls(len(n), pa.int32()), sender, pa.nulls(len(n), pa.binary()), *columns], sent.names)
            if size >= FLUSH_TOKENS:
                yield from flush()
                size = 0
        if size:
            yield from flush()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of texts pass; the blocks of each part are answered by one packed reply per sender."""
        words, backoffs = shared.value, lookup.value[0]
        held: list[tuple[int, int, bytes]] = []
        now = None
        empty: list = []

        def replies() -> Iterator[pa.RecordBatch]:
            rows = [(base, pack_sums(*sums)) for base, sums in answered(held, words, backoffs)]
            if rows:
                columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.nulls(len(rows), k) for k in empty)], replied.names)

        for batch in batches:
            own = batch.filter(batch.column(3).is_null())
            empty = [c.type for c in own.columns[4:]]
            yield own.select(replied.names)
            blocks = batch.filter(batch.column(3).is_valid())
            for part, kind, base, data in zip(*(blocks.column(i).to_pylist() for i in range(4)), strict=True):
                if part != now:
                    yield from replies()
                    held.clear()
                    now = part
                held.append((kind, base, data))
        yield from replies()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Replies added to the rows of the texts their sender had, sorted by sender, replies first."""
        now = None
        sums: list[tuple] = []
        for batch in batches:
            for base in dict.fromkeys(batch.column(0).to_pylist()):
                own = batch.filter(pc.equal(batch.column(0), base))
                if base != now:
                    now, sums = base, []
                sums += [unpack_sums(d) for d in own.column(1).drop_null().to_pylist()]
                texts = own.filter(own.column(1).is_null())
                if not len(texts):
                    continue
                place = np.asarray(texts.column(2)) - base
                totals = [np.asarray(texts.column(i)).copy() for i in (5, 6, 7)]
                where = np.full(int(place.max()) + 1, -1, dtype=np.int64)
                where[place] = np.arange(len(place))
                for row, *values in sums:
                    inside = row < len(where)
                    at = where[row[inside]]
                    for total, value in zip(totals, values, strict=True):
                        np.add.at(total, at[at >= 0], value[inside][at >= 0])
                yield pa.RecordBatch.from_arrays([texts.column(3), texts.column(4), *(pa.array(x) for x in totals)], summed.names)

    numbered = docs.select(
        F.monotonically_increasing_id().alias("__row"), "doc_id", held_out(F.col("doc_id")).alias("__held"), text
    )
    tokens = numbered.mapInArrow(look_up, StructType([StructField(f.name, f.dataType) for f in sent.fields]))
    known_word = bigrams.filter(is_frequent(F.col("word"), width)).withColumn("word_count", F.lit(0).cast("long"))
    cold = known_word.unionByName(rare).filter(~is_hot).mapInArrow(cold_counts, BLOCK)
    others = contexts.filter(~is_frequent(F.col("context"), width)).mapInArrow(cold_contexts, BLOCK)
    padded = cold.unionByName(others).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in made.fields])
    dealt = tokens.unionByName(padded).repartition("part").sortWithinPartitions("part")
    replied = StructType([f for f in sent.fields if f.name not in ("part", "kind")])
    summed = StructType([f for f in made.fields if f.name != "__row"])
    replies = dealt.mapInArrow(answer, replied)
    senders = replies.repartition("from_row").sortWithinPartitions("from_row", F.col("data").isNull())
    return senders.mapInArrow(add_up, summed).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score",
    )


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of a few million rows at a time."""
    held: list[list[np.ndarray]] = []
    size = 0
    for batch in batches:
        held.append([np.asarray(c) for c in batch.columns])
        size += len(batch)
        if size >= FLUSH_TOKENS:
            yield [np.concatenate(x) for x in zip(*held, strict=True)]
            held, size = [], 0
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def pack_sums(rows: np.ndarray, known: np.ndarray, base: np.ndarray, log: np.ndarray) -> bytes:
    raw = rows.astype(np.uint32).tobytes() + known.astype(np.uint32).tobytes() + base.tobytes() + log.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack_sums(data: bytes) -> tuple[np.ndarray, ...]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = len(raw) // 24
    whole = (np.frombuffer(raw, np.uint32, n, offset).astype(np.int64) for offset in (0, 4 * n))
    return (*whole, *(np.frombuffer(raw, np.float64, n, offset) for offset in (8 * n, 16 * n)))


def answered(blocks: list[tuple[int, int, bytes]], words: Unigrams, backoffs: Backoff) -> Iterator[tuple[int, tuple]]:
    """Sums per text over the blocks of one part, by sender: rows, known tokens, base score, score."""
    held: dict[int, list] = {k: [] for k in range(WORDS_HELD + 1)}
    for kind, base, data in blocks:
        held[kind].append((base, data))
    width = np.uint64(words.width)
    found: dict[int, list] = {}

    def table(kind: int, columns: int) -> list[np.ndarray]:
        loaded = [unpack(data) for _, data in held.pop(kind)]
        empty = [np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * columns]
        return [np.concatenate(x) for x in zip(empty, *loaded, strict=True)]

    if held[PAIRS_TRAINED] or held[PAIRS_HELD]:
        loaded = [(np.array([2**64 - 1], np.uint64), *[np.zeros(1, np.uint32)] * 2)]
        for _, data in held.pop(PAIR_COUNTS):
            before, low, high, *values = unpack(data)
            loaded.append((pair_keys(before, whole(low, high)), *(v.astype(np.uint32) for v in values)))
        keys, counts, word_counts = (np.concatenate(x) for x in zip(*loaded, strict=True))
        del loaded
        order = np.argsort(keys)
        keys, counts, word_counts = keys[order], counts[order], word_counts[order]
        contexts, totals, *rest = table(CONTEXTS, 5)
        order = np.argsort(contexts)
        contexts, totals = np.append(contexts[order], np.uint64(2**64 - 1)), np.append(totals[order], 0)
        scales, weights = (np.append(whole(*x, np.float64)[order], 1.0) for x in (rest[:2], rest[2:]))
        # Frequent contexts come first in all three, so that a code is its own place.
        totals, scales, weights = (np.concatenate(x) for x in ((backoffs.counts, totals), (backoffs.scale, scales), (backoffs.weight, weights)))
        log_frequent = np.log10(words.probability(words.counts))
        for kind in (PAIRS_TRAINED, PAIRS_HELD):
            for base, data in held[kind]:
                before, low, high, row = unpack(data)
                codes = whole(low, high)
                pairs = pair_keys(before, codes)
                at = np.searchsorted(keys, pairs)
                hit = keys[at] == pairs
                count = np.where(hit, counts[at], 0).astype(np.int64)
                place = np.searchsorted(contexts, before)
                place = np.where(contexts[place] == before, place, len(contexts) - 1) + words.width
                place = np.where(before < width, before, place.astype(np.uint64)).astype(np.int64)
                logs = np.log10(np.where(hit, backoffs.seen(count, totals[place], scales[place]), weights[place]))
                # The unigram: of frequent words here; the part of any other held-out word adds it in all cases.
                own = codes < width
                below = ~hit & own
                logs[below] += log_frequent[codes[below].astype(np.int64)]
                if kind == PAIRS_HELD:
                    above = hit & ~own
                    logs[above] -= np.log10(words.probability(word_counts[at[above]]))
                found.setdefault(base, []).append((row, np.zeros(len(row)), np.zeros(len(row)), logs))
    trained = [(base, unpack(data)) for base, data in held[WORDS_TRAINED]]
    keys, counts = counted(np.concatenate([np.zeros(0, np.uint64), *(x[0] for _, x in trained)]))
    keys, counts = np.append(keys, np.uint64(2**64 - 1)), np.append(counts, 0)
    for kind in (WORDS_TRAINED, WORDS_COUNTED, WORDS_HELD):
        for base, (tokens, row) in trained if kind == WORDS_TRAINED else ((base, unpack(data)) for base, data in held[kind]):
            at = np.searchsorted(keys, tokens)
            count = np.where(keys[at] == tokens, counts[at], 0)
            logs = np.log10(words.probability(count)) if kind == WORDS_HELD else np.zeros(len(row))
            found.setdefault(base, []).append((row, count > 0, words.base(count), logs))
    for base, parts in found.items():
        row, *values = (np.concatenate(x) for x in zip(*parts, strict=True))
        rows, at = np.unique(row, return_inverse=True)
        known, base_log, log = (np.bincount(at, weights=v, minlength=len(rows)) for v in values)
        yield base, (rows, np.rint(known), base_log, log)
