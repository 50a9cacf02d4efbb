"""License scans by diagonal voting.

All rolling word five-grams of all texts are hashed and joined with the positions of the same hashes
in license templates. A match votes for the diagonal (text position minus template position). Votes
are counted per diagonal, neighbouring diagonals (shifted by a few inserted or dropped words) are
merged unless they hold mostly the same template words, which then stand there twice, and the merged
run is verified: the share of the template's words that its matches cover has to reach the similarity.
Names of licenses in running text are found beside that as plain phrases. Templates and phrases are
arguments; those of the library are its defaults.

Defined cases: a NULL or empty text, or one of fewer than five words, has no matches; a template of
fewer than five words is an error; very long texts go through batches of bounded bytes; repeated rows
are scanned each for itself; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from statelake.llm.common import fit_python, stored
from statelake.llm.license_texts import PHRASES, TEMPLATES
from statelake.llm.tokens import ALPHANUMERIC, span_hashes, word_hashes

GRAM = 5
# Templates of more five-grams than this meet the texts by a shuffle.
BROADCAST_GRAMS = 1_000_000
Named = Sequence[tuple[str, str]]


@dataclass(frozen=True)
class LicenseRules:
    """``slack`` is how far apart neighbouring diagonals may lie."""

    similarity: float = 0.8
    slack: int = 8


def gram_hashes(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The hash of the five-gram at each of the ``starts``."""
    return span_hashes(words, starts, starts + GRAM).view(np.int64)


def template_positions(spark: SparkSession, templates: Named = TEMPLATES) -> DataFrame:
    """``(gram, template, label, at, length)``; as many rows as the templates (label, text) have five-grams."""
    hashes, rows = word_hashes(pa.array([text for _, text in templates], pa.string()), ALPHANUMERIC)
    if len(templates) and int(np.diff(rows).min()) < GRAM:
        raise ValueError(f"a template needs at least {GRAM} words")
    found = []
    for k, (label, _) in enumerate(templates):
        own = hashes[rows[k] : rows[k + 1]]
        grams = gram_hashes(own, np.arange(len(own) - GRAM + 1))
        found += [(int(g), k, label, at, len(own)) for at, g in enumerate(grams)]
    positions = spark.createDataFrame(found, "gram bigint, template int, label string, at int, length int")
    return F.broadcast(positions) if len(found) <= BROADCAST_GRAMS else positions


def grams_of(docs: DataFrame, carry: list[str], text: str = "text", named: Named = PHRASES) -> DataFrame:
    """Every row with its words, its phrases, and the hashes of all its five-grams in order."""
    spark = docs.sparkSession
    fit_python(spark)
    hashes, rows = word_hashes(pa.array([p for p, _ in named], pa.string()), ALPHANUMERIC)
    phrases = [(hashes[rows[k] : rows[k + 1]], label) for k, (_, label) in enumerate(named)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, rows = word_hashes(batch.column(len(carry)), ALPHANUMERIC)
            n = np.diff(rows)
            row = np.repeat(np.arange(len(n)), n)
            places, labels = [], [set() for _ in n]
            for phrase, label in phrases:
                at = np.arange(max(0, len(words) - len(phrase) + 1))
                same = row[at] == row[at + len(phrase) - 1]
                for k, h in enumerate(phrase):
                    same &= words[at + k] == h
                places.append(at[same])
                for r in np.unique(row[at[same]]):
                    labels[r].add(label)
            found = np.sort(np.concatenate([np.zeros(0, np.int64), *places]))
            count = np.bincount(row[found], minlength=len(n))
            ends = np.cumsum(count)
            some = count > 0
            first, last = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            first[some] = found[(ends - count)[some]] - rows[:-1][some]
            last[some] = found[ends[some] - 1] - rows[:-1][some]
            grams = np.maximum(n - GRAM + 1, 0)
            bounds = np.concatenate([[0], np.cumsum(grams)])
            starts = np.arange(bounds[-1]) + np.repeat(rows[:-1] - bounds[:-1], grams)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(len(carry))),
                    pa.array(n),
                    pa.array(count),
                    pa.array(first, mask=~some),
                    pa.array(last, mask=~some),
                    pa.array([sorted(x) for x in labels], pa.list_(pa.string())),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(gram_hashes(words, starts))),
                ],
                [*carry, *names],
            )

    made = StructType.fromDDL(
        "n_words bigint, n_base bigint, first_word bigint, last_word bigint, found array<string>, grams array<bigint>"
    )
    names = made.names
    return docs.select(*carry, text).mapInArrow(run, StructType([docs.schema[c] for c in carry] + made.fields))


def verified_spans(votes: DataFrame, rules: LicenseRules) -> DataFrame:
    """Per row and template the runs that cover enough of the template: label, words, score."""
    by_diagonal = Window.partitionBy("__row", "template").orderBy("diagonal")
    diagonals = votes.groupBy("__row", "template", "label", "length", "diagonal").agg(F.collect_set("at").alias("at"))
    before = F.lag("at").over(by_diagonal)
    step = F.col("diagonal") - F.lag("diagonal").over(by_diagonal)
    again = 2 * F.size(F.array_intersect("at", before)) > F.least(F.size("at"), F.size(before))
    apart = F.coalesce(((step > rules.slack) | again).cast("int"), F.lit(0))
    runs = diagonals.withColumn("apart", apart).withColumn("run", F.sum("apart").over(by_diagonal))
    merged = runs.groupBy("__row", "template", "label", "length", "run").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("at")))).alias("at"),
        F.min(F.col("diagonal") + F.array_min("at")).alias("start"),
        F.max(F.col("diagonal") + F.array_max("at") + GRAM).alias("end"),
    )
    gaps = F.zip_with("at", F.slice("at", 2, F.size("at")), lambda x, y: F.least(F.lit(GRAM), F.coalesce(y - x, F.lit(GRAM))))
    covered = F.aggregate(gaps, F.lit(0), lambda acc, g: acc + g)
    scored = merged.withColumn("score", covered / F.col("length"))
    return scored.filter(F.col("score") >= rules.similarity).select("__row", "label", "start", "end", "score")


def license_scan(
    docs: DataFrame,
    carry: list[str],
    rules: LicenseRules = LicenseRules(),
    text: str = "text",
    templates: Named = TEMPLATES,
    phrases: Named = PHRASES,
) -> DataFrame:
    """Every row with its phrases, all labels, the verified spans and the best score.

    ``templates`` are pairs of label and text, ``phrases`` of text and label. A row goes on with its
    matches and its first gram only.
    """
    spark = docs.sparkSession
    rows = grams_of(docs, carry, text, phrases).select(F.monotonically_increasing_id().alias("__row"), "*")
    kept = [c for c in rows.columns if c != "grams"]
    exploded = rows.select(*kept, F.posexplode_outer("grams").alias("place", "gram"))
    joined = exploded.join(template_positions(spark, templates), "gram", "left")
    seen = stored(joined.filter(F.col("template").isNotNull() | (F.coalesce("place", F.lit(0)) == 0)), "license-votes")
    votes = seen.filter(F.col("template").isNotNull()).withColumn("diagonal", F.col("place") - F.col("at"))
    per_row = (
        verified_spans(votes, rules)
        .groupBy("__row")
        .agg(
            F.max("score").alias("score"),
            F.collect_set("label").alias("__labels"),
            F.array_sort(F.collect_list(F.struct("start", "end", "label", "score"))).alias("spans"),
        )
    )
    base = seen.filter(F.coalesce("place", F.lit(0)) == 0).select(*kept).dropDuplicates(["__row"])
    none = F.array().cast("array<string>")
    return base.join(per_row, "__row", "left").select(
        *carry, "n_words", "n_base", "first_word", "last_word",
        F.array_join("found", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("found", F.coalesce("__labels", none))), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        "spans",
    )
