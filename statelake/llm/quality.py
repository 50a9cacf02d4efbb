"""Quality rules: heuristic counts, and a hashed n-gram likelihood ratio against the raw corpus.

Every text gets the counts of its words, symbols, repeated lines and repeated word windows. Beside
them, two multinomials over hashed word unigrams and bigrams are counted, one over the trusted
documents and one over the whole corpus. A document's score is its log-likelihood under the first
minus that under the second, divided by its number of n-grams; documents below a fixed threshold go.

Defined cases: a NULL or empty text has no words and fails; repeated rows are judged alike, each
counts in the raw corpus; a trusted id that occurs twice in the labels counts once; without trusted
documents the two models are equal up to smoothing, nothing is rejected by the ratio (it is taken as
zero); an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from statelake.llm.common import spaced, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class QualityRules:
    """``buckets`` bounds the tables of the two models, ``max_trusted`` the ids that are broadcast
    (those with the smallest hash when there are more). ``threshold`` is in nats per n-gram."""

    min_words: int = 20
    max_repeat_percent: int = 30
    buckets: int = 16_384
    smoothing: float = 1.0
    threshold: float = -0.15
    max_trusted: int = 200_000


def window_hashes(h: Column, n: int) -> Column:
    """The hash of each word hash with the ``n - 1`` after it; past the end there are only those left."""
    return F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, n)]))


def repeated_words(ones: Column) -> Column:
    """How many words lie in a window of eight words that occurs at least twice in the text.

    Windows are compared by hash. Only a text with equal hashes goes on to sort them with their
    places; the covered words are then summed from the gaps between neighbouring places.
    """

    def covered(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.slice(s, 1, F.size(s) - 1))
            after = F.slice(s, 2, F.size(s))
            near = F.zip_with(before, after, lambda b, a: F.struct(b.h.alias("b"), a.h.alias("a")))
            tagged = F.zip_with(s, near, lambda x, y: F.when((x.h == y.b) | (x.h == y.a), x.i))
            return F.array_sort(F.filter(tagged, lambda x: x.isNotNull()))

        def total(p: Column) -> Column:
            gaps = F.zip_with(p, F.slice(p, 2, F.size(p)), lambda x, y: F.least(F.lit(WINDOW), F.coalesce(y - x, F.lit(WINDOW))))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, g: acc + g)

        return _let(_let(placed, places), total)

    def decide(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("long"))

    eights = F.slice(window_hashes(ones, WINDOW), 1, F.size(ones) - WINDOW + 1)
    return F.when(F.size(ones) > WINDOW, _let(eights, decide)).otherwise(F.lit(0).cast("long"))


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def hashed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__h``, the hashes of its words, and ``__hh``, those of its word pairs.

    They come out of a one-row generator. A later filter on what is derived from them is pushed down
    to it but not through it; otherwise the optimizer would repeat the hashing at every use.
    """
    ones = F.transform(words(F.col(text)), lambda x: F.xxhash64(x))
    both = F.transform(F.array(ones), lambda h: F.struct(h.alias("__h"), window_hashes(h, 2).alias("__hh")))
    return docs.select("*", F.inline(both))


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with its word hashes and the base counts; ``text`` itself stays."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = {
        "n_words": F.size("__h").cast("long"),
        "word_chars": F.char_length(F.replace(spaced(F.col(text)), F.lit(" "), F.lit(""))).cast("long"),
        "n_symbols": F.char_length(F.regexp_replace(t, "[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": repeated_words(F.col("__h")),
    }
    return hashed(docs, text).withColumn("__lines", lines).withColumns(counts).drop("__lines")


def base_failed(rules: QualityRules) -> Column:
    too_short = F.col("n_words") < rules.min_words
    return too_short | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))


def buckets_of(grams: Column, rules: QualityRules) -> Column:
    return F.pmod(grams, F.lit(rules.buckets)).cast("int")


def trusted_ids(labels: DataFrame, rules: QualityRules) -> DataFrame:
    """The trusted document ids: labelled good and never labelled bad or toxic; at most ``max_trusted``."""
    good = (
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
        .filter((F.col("quality") == 1) & (F.col("toxic") == 0))
        .select("doc_id")
    )
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rules.max_trusted)


def gram_counts(docs: DataFrame, trusted: DataFrame, rules: QualityRules, text: str = "text") -> DataFrame:
    """``(bucket, raw, target)``: n-grams of the corpus and of its trusted part; at most ``buckets`` rows."""
    marked = docs.select("doc_id", text).join(F.broadcast(trusted.withColumn("trusted", F.lit(1))), "doc_id", "left").select(
        text, F.coalesce("trusted", F.lit(0)).alias("trusted")
    )
    grams = hashed(marked, text).select("trusted", F.explode(F.concat("__h", "__hh")).alias("gram"))
    counts = grams.groupBy(buckets_of(F.col("gram"), rules).alias("bucket"))
    return counts.agg(F.count("*").alias("raw"), F.sum("trusted").alias("target"))


def log_ratios(counts: list[Row], rules: QualityRules) -> list[float]:
    """Per bucket the log of the trusted over the raw probability; zero where nothing was counted."""
    weights = [0.0] * rules.buckets
    all_raw, all_target = sum(r["raw"] for r in counts), sum(r["target"] for r in counts)
    if not all_target:
        return weights
    mass = rules.smoothing * rules.buckets
    level = math.log((all_raw + mass) / (all_target + mass))
    for r in counts:
        weights[r["bucket"]] = round(math.log((r["target"] + rules.smoothing) / (r["raw"] + rules.smoothing)) + level, 6)
    return weights


def score(weights: list[float], rules: QualityRules) -> Column:
    """The mean weight of a row's n-grams, from its word and word-pair hashes; zero without words."""
    table = F.split(F.lit(",".join(repr(w) for w in weights)), ",").cast("array<double>")
    add = lambda acc, gram: acc + F.get(table, F.pmod(gram, F.lit(rules.buckets)).cast("int"))
    ones = F.aggregate("__h", F.lit(0.0), add)
    both = F.aggregate("__hh", ones, add)
    return F.when(F.size("__h") > 0, F.round(both / (F.size("__h") + F.size("__hh")), 9)).otherwise(F.lit(0.0))


def judge(docs: DataFrame, weights: list[float], rules: QualityRules, text: str = "text") -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``score`` and ``kept``; every row stays where it is."""
    return (
        counted(docs, text)
        .withColumn("base_failed", base_failed(rules))
        .withColumn("score", score(weights, rules))
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= rules.threshold))
        .drop("__h", "__hh")
    )


def quality(
    docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules(), text: str = "text", carry: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Judge all documents; beside the verdict a row keeps ``carry`` and its text.

    The counts (``buckets`` rows at most) pass through the driver.
    """
    counts = gram_counts(docs, trusted_ids(labels, rules), rules, text).collect()
    return judge(docs.select(*carry, text), log_ratios(counts, rules), rules, text)
