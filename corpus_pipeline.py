"""A corpus pipeline of five stages; each reads what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statelake.llm import decontam, mixing, quality, secrets, simhash
from statelake.llm.common import read_table
from statelake.session import scratch_dropped, scratch_path
from statelake.sources.paths import delete


def packed(docs: DataFrame) -> DataFrame:
    """Id, text and the whole row as one struct, so that no column of it clashes with an operator's."""
    return docs.select("doc_id", "text", F.struct(*docs.columns).alias("__doc"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    judged = quality.quality(packed(docs), read_table(spark, sf_dir, "labels"), carry=("__doc",))
    return judged.filter("kept").select("__doc.*")


def one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule names go; all others stay as they are."""
    judged = decontam.contamination(packed(docs), read_table(spark, sf_dir, "benchmark"), ["__doc"])
    return judged.filter(~F.col("contaminated")).select("__doc.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are replaced by a marker in their documents, whose length is counted anew."""
    length = F.when(F.contains("text", F.lit(secrets.REDACTED)), F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return secrets.redact(docs).withColumn("n_chars", length)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words taken from each document and their places in training, sorted by place."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", keep_quality),
    ("simhash near-dedup", one_of_copies),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact_secrets),
    ("mixing sources", mix_sources),
]
# SQL has no function for the hashes of the quality stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again.

    What a stage wrote for itself goes with it; the rows of a stage go when the next one has written its own.
    """
    docs, last = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        with scratch_dropped(spark) as kept:
            kept.add(path)
            found = stage(spark, docs, sf_dir)
            found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
        if last:
            delete(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
