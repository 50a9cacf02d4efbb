"""Parquet trees and CSV files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from statelake.schemas import BRONZE_PARTITIONS, BRONZE_SCHEMA


def read_parquet(
    spark: SparkSession, path: str, schema: StructType | None = None, base_path: str | None = None
) -> DataFrame:
    """A Parquet scan. A declared schema saves reading footers; ``base_path`` keeps the partition
    columns when ``path`` points inside the tree."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    return reader.parquet(path)


def read_bronze(spark: SparkSession, path: str, since: Column | None = None) -> DataFrame:
    """The raw layer; ``since`` is a condition on ``raw_date``/``raw_hour`` and prunes directories."""
    bronze = read_parquet(spark, path, BRONZE_SCHEMA, path)
    return bronze if since is None else bronze.filter(since)


def landed_from(date: str, hour: int = 0) -> Column:
    """Condition for raw partitions written at or after an hour, in a form Spark prunes by."""
    day = F.lit(date).cast("date")
    return (F.col("raw_date") > day) | ((F.col("raw_date") == day) & (F.col("raw_hour") >= hour))


def append_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = BRONZE_PARTITIONS) -> None:
    """Append in place. A raw batch has one landing hour, so each task writes one file and no shuffle
    is needed to keep the file count down."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Headed CSV with a declared schema; inferring one would read the file twice."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Headed CSV parts."""
    df.write.mode("overwrite").option("header", True).csv(path)
