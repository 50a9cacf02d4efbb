"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statelake.session import scratch_path

# The white space that separates words, as a character class.
SPACE = r"[\x20\x09-\x0D]"
# Rows and bytes of an Arrow batch handed to Python, whichever comes first: a batch has to fit beside
# its arrays, which take many times its bytes, and some texts are very long.
ARROW_ROWS = 512
ARROW_BYTES = 4 * 1024 * 1024
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def fit_python(spark: SparkSession) -> None:
    """Keep Arrow batches of texts small (only ever lowers the session's setting), and let Python
    workers find this package where it lies; a cluster may ship it with ``--py-files`` as well."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in (f"{64 * 1024 * 1024}b", "64m", "-1"):  # its default, or none; a bound set by hand stays
        spark.conf.set(key, str(ARROW_BYTES))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (known, ROOT) if p)


def spaced(text: Column) -> Column:
    """``text`` with every kind of white space as a plain space; NULL as the empty text."""
    result = F.coalesce(text, F.lit(""))
    for other in "\n\t\r\x0b\x0c":
        result = F.replace(result, F.lit(other), F.lit(" "))
    return result


def words(text: Column) -> Column:
    """The words of a text as an array; a NULL text has none.

    Plain replacements and a split at one character are several times faster than a pattern.
    """
    return F.array_remove(F.split(spaced(text), " "), "")


def source_key(source: Column) -> Column:
    """A never-NULL form of a source name that sorts by code point, NULL last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and scanned from there.

    Cuts the lineage, fixes generated row numbers, survives lost executors, and gives later joins
    the true size. The folder belongs to the result that reads it, so it is not deleted here.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
