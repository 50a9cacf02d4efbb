"""A prefix trie over rebuilt conversations, by composable fingerprints.

A conversation is rebuilt as a head, the first turns of its group's base conversation, and a suffix,
its own turns after as many. Fingerprints form a monoid: a sequence stands for its length and, for
each of four primes, the sum of its turns' digests times powers of a base. Running sums give the
fingerprint of every prefix of every stored conversation, and those of rebuilt prefixes follow from
them by arithmetic: head plus (own prefix minus own head), moved by a power of the base. No rebuilt
text is ever made, and what moves is numbers.

Prefixes with equal length and fingerprint form a node. Each is verified through the stored turns it
refers to: all members must agree in the 128-bit reference (from SHA-256 of role and text) of their
last turn and in the fingerprint of the prefix before it; by induction they then are equal. If that
ever fails, everything is done anew with other bases.

The smallest member of a node owns it. A conversation owns the nodes of its own path from some depth
on, so sums over subtrees need no walk: the subtree of a node consists of the nodes that its members
own at its depth or below, which are running sums along each member, added up per node.

Defined cases: turns with equal numbers stand in the order of their references, repeated rows count as
turns each; a NULL role or text is empty, a NULL turn comes first; rows without a conversation id
belong to no conversation and are left out; very long texts are hashed where they lie, long
conversations and nodes with most of all members are spread over tasks (``ranks``); an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statelake.llm.common import fit_python, stored
from statelake.llm.ranks import dealt, placed, running

# The four largest primes below 2**31, so that products of two residues fit a long.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
HALF = (1 << 31) - 1
KEY = ["depth", "k1", "k2"]
# Ids of one node that are joined to one text before they meet the others of the node.
CHUNK = 1024


@dataclass(frozen=True)
class TrieRules:
    """Conversations of one group share ``id // group``; the base is the group's first id. ``most_head``
    is the largest number of head turns and ``head`` the SQL expression for a conversation's number."""

    group: int = 100
    most_head: int = 5
    head: str = "CAST(crc32(CAST(conv_id AS STRING)) % 6 AS INT)"
    seed: int = 0
    tries: int = 8

    def base(self, j: int) -> int:
        return pow(48271 + 2 * self.seed, j + 2, PRIMES[j])


def _power(rules: TrieRules, j: int, exponent: Column) -> Column:
    """The base to a power below 2**32, four bits of it at a time."""
    p, result = PRIMES[j], F.lit(1).cast("long")
    for step in range(8):
        table = [pow(rules.base(j), m << (4 * step), p) for m in range(16)]
        digit = F.shiftright(exponent, 4 * step).bitwiseAND(F.lit(15)).cast("int")
        result = result * F.get(F.array(*[F.lit(v).cast("long") for v in table]), digit) % p
    return result


def _residues(first: Column, second: Column) -> list[Column]:
    """Four numbers below 2**31 from the two halves of a turn's reference."""
    low, high = (lambda c: c.bitwiseAND(F.lit(HALF))), (lambda c: F.shiftrightunsigned(c, 33))
    return [low(first), high(first), low(second), high(second)]


def _terms(rules: TrieRules, place: Column) -> list[Column]:
    """What a turn adds to the fingerprint at a place."""
    return [x % PRIMES[j] * _power(rules, j, place) % PRIMES[j] for j, x in enumerate(_residues(F.col("r1"), F.col("r2")))]


def _key(parts: list[Column]) -> list[Column]:
    """Four residues as two longs."""
    pair = lambda a, b: F.shiftleft(a, 31).bitwiseOR(b)
    return [pair(parts[0], parts[1]), pair(parts[2], parts[3])]


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, the reference of the turn's content (``r1``, ``r2``) and its length."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    content = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    number = lambda at: F.conv(F.substring(content, at, 16), 16, -10).cast("long")
    rows = conversations.filter("conv_id IS NOT NULL")
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", number(1).alias("r1"), number(17).alias("r2"), F.char_length(text).alias("length"))


def prefixes(fixed: DataFrame, rules: TrieRules) -> DataFrame:
    """Every stored turn with its place and the fingerprint of the prefix that ends with it (``s0`` to ``s3``)."""
    at = placed(fixed, ["conv_id"])
    termed = at.withColumns({f"t{j}": t for j, t in enumerate(_terms(rules, F.col("__place")))})
    summed = running(termed, ["conv_id"], {f"s{j}": f"t{j}" for j in range(4)})
    return summed.select(
        "conv_id", F.col("__place").alias("place"), F.col("__size").alias("size"), "r1", "r2", "length",
        *[(F.col(f"s{j}") % PRIMES[j]).alias(f"s{j}") for j in range(4)],
    )


def _heads(stored_turns: DataFrame, rules: TrieRules) -> DataFrame:
    """One row per conversation: its size, head turns, the fingerprint of the head and of its own turns
    that the head replaces, and the rebuilt length."""
    own = stored_turns.withColumn("h", F.expr(rules.head)).filter("place = 0 OR place = h - 1")
    mine = own.groupBy("conv_id", "h").agg(
        F.max("size").alias("size"), *[F.coalesce(F.max(F.when(F.col("place") == F.col("h") - 1, F.col(f"s{j}"))), F.lit(0)).alias(f"q{j}") for j in range(4)]
    )
    base = F.col("conv_id") - F.col("conv_id") % rules.group
    turn = F.struct("place", "r1", "r2", "length", *[f"s{j}" for j in range(4)])
    bases = (
        stored_turns.filter((F.col("conv_id") % rules.group == 0) & (F.col("place") < rules.most_head))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.array_sort(F.collect_list(turn)).alias("head"))
    )
    joined = mine.withColumn("base", base).join(bases, "base", "left").withColumn("head", F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("h")))
    last = F.get("head", F.size("head") - 1)
    return joined.select(
        "conv_id", "h", "head", F.size("head").alias("hn"),
        *[F.coalesce(last[f"s{j}"], F.lit(0)).alias(f"b{j}") for j in range(4)], *[f"q{j}" for j in range(4)],
        (F.size("head") + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("total"),
    )


def rebuilt(stored_turns: DataFrame, rules: TrieRules) -> DataFrame:
    """One row per rebuilt conversation and depth, from 0: the key of the prefix, that of the prefix one
    shorter, the reference and length of the last turn, and whether the conversation ends there."""
    heads = stored(_heads(stored_turns, rules), "trie-heads")
    first = heads.select("conv_id", "total", F.explode("head").alias("t")).select(
        "conv_id", "total", (F.col("t.place") + 1).alias("depth"), "t.r1", "t.r2", "t.length", *[F.col(f"t.s{j}").alias(f"f{j}") for j in range(4)]
    )
    later = stored_turns.filter(F.col("place") >= F.expr(rules.head)).join(heads.drop("head"), "conv_id")
    moved = []
    for j in range(4):
        p = PRIMES[j]
        back = F.array(*[F.lit(pow(rules.base(j), -m, p)).cast("long") for m in range(rules.most_head + 1)])
        suffix = F.pmod(F.col(f"s{j}") - F.col(f"q{j}"), F.lit(p)) * F.get(back, F.col("h") - F.col("hn")) % p
        moved.append(((F.col(f"b{j}") + suffix) % p).alias(f"f{j}"))
    rest = later.select("conv_id", "total", (F.col("hn") + F.col("place") - F.col("h") + 1).alias("depth"), "r1", "r2", "length", *moved)
    both = first.unionByName(rest)
    terms = _terms(rules, F.col("depth") - 1)
    k1, k2 = _key([F.col(f"f{j}") for j in range(4)])
    p1, p2 = _key([F.pmod(F.col(f"f{j}") - terms[j], F.lit(PRIMES[j])) for j in range(4)])
    ends = (F.col("depth") == F.col("total")).alias("ends")
    rows = both.select("conv_id", "depth", k1.alias("k1"), k2.alias("k2"), p1.alias("p1"), p2.alias("p2"), "r1", "r2", "length", ends)
    nought = F.lit(0).cast("long")
    roots = heads.select(
        "conv_id", nought.alias("depth"), *[nought.alias(c) for c in ("k1", "k2", "p1", "p2", "r1", "r2")], F.lit(0).alias("length"), (F.col("total") == 0).alias("ends")
    )
    return rows.unionByName(roots)


def nodes_of(rows: DataFrame) -> DataFrame:
    """The nodes: owner, members, the parent's key, length of the last turn, and whether all agree."""
    checked = ["p1", "p2", "r1", "r2"]
    grouped = rows.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("length").alias("length"),
        *[F.min(c).alias(c) for c in checked], *[F.max(c).alias(f"__{c}") for c in checked],
    )
    agree = F.lit(True)
    for c in checked:
        agree = agree & (F.col(c) == F.col(f"__{c}"))
    return grouped.select(*KEY, "conv_id", "n_convs", "length", "p1", "p2", agree.alias("agree"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the texts of each key, which come in order; only one hash state is held."""
    now, state, done = None, None, []

    def flush() -> pa.RecordBatch:
        columns = [pa.array([d[0][i] for d in done], pa.int64()) for i in range(3)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([d[1] for d in done], pa.string())], [*KEY, "ends_sha256"])

    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in KEY))
        for key, text in zip(keys, batch.column("ids")):
            if key != now:
                if state is not None:
                    done.append((now, state.hexdigest()))
                now, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.as_buffer())
        if len(done) >= CHUNK:
            yield flush()
            done = []
    if state is not None:
        done.append((now, state.hexdigest()))
        yield flush()


def ends_of(rows: DataFrame) -> DataFrame:
    """Per node with ends, the digest of the ascending ids of the conversations that end there.

    Ids are joined to texts of at most ``CHUNK`` ids wherever they lie in the common order; one task
    per node then hashes these, text after text, since SHA-256 has only one order to go in.
    """
    fit_python(rows.sparkSession)
    fixed = dealt(rows.filter("ends").select(*KEY, "conv_id"), KEY, [F.col("conv_id")], "trie-ends")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    chunks = fixed.groupBy(*KEY, F.floor(F.col("__at") / CHUNK).alias("chunk")).agg(ids.alias("ids"))
    in_order = chunks.repartition(*KEY).sortWithinPartitions(*KEY, "chunk").select(*KEY, "ids")
    return in_order.mapInArrow(_digests, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame, rules: TrieRules = TrieRules()) -> DataFrame:
    """One row per node of the trie over the rebuilt conversations."""
    fixed = dealt(stored(turns(conversations), "trie-turns"), ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("r1"), F.col("r2")], "trie-order")
    for seed in range(rules.seed, rules.seed + rules.tries):
        now = TrieRules(rules.group, rules.most_head, rules.head, seed, 1)
        rows = stored(rebuilt(stored(prefixes(fixed, now), "trie-prefixes"), now), "trie-rows")
        nodes = stored(nodes_of(rows), "trie-nodes")
        if nodes.filter("NOT agree").isEmpty():
            return _summed(rows, nodes)
    raise RuntimeError("fingerprints of different prefixes met under every base")


def _summed(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    parent = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    below = nodes.filter("depth > 0").groupBy(*parent).agg(F.count("*").alias("n_children"))
    known = stored(
        nodes.join(below, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).drop("agree"), "trie-known"
    )
    owned = known.select(
        "conv_id", "depth", ((F.col("n_convs") - 1) * F.col("length")).alias("saved"), (F.col("n_children") == 0).cast("long").alias("leaf")
    )
    marked = rows.select("conv_id", *KEY).join(owned, ["conv_id", "depth"], "left")
    weighed = stored(marked.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("saved", "leaf")}), "trie-weighed")
    upward = dealt(weighed, ["conv_id"], [F.col("depth").desc()], "trie-upward")
    along = running(upward, ["conv_id"], {"saved_tokens": "saved", "n_leaves": "leaf"})
    totals = along.groupBy(*KEY).agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))
    above = known.select(F.col("depth").alias("__d"), F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("conv_id").alias("parent_conv_id"))
    to_parent = (F.col("depth") - 1 == F.col("__d")) & (F.col("p1") == F.col("__k1")) & (F.col("p2") == F.col("__k2"))
    named = known.join(above, to_parent, "left")
    none = F.lit(hashlib.sha256().hexdigest())
    result = named.join(totals, KEY).join(ends_of(rows), KEY, "left")
    return result.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")
    )
