"""CSV files whose headers and lines are held against a declared schema.

Columns are found by the name in each file's own header, so files may order them differently or have
more of them. Files whose header lacks a column, and lines that cannot be read as declared, are set
aside with a reason instead of shifting values into wrong columns or failing the job.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Files of one table differ in a few generations of their header, not in thousands.
MAX_HEADERS = 1000
LINE = "__line"
REJECTS = "file string, line string, reason string"


def header_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, header)``: the first line of every file that has one. One scan that keeps a row per file and task."""
    start = F.col("_metadata.file_block_start") == 0
    lines = spark.read.text(path).filter(start).select(F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("at"))
    return lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))


def header_names(header: str) -> list[str]:
    return [name.strip().removeprefix("\ufeff") for name in next(csv.reader([header]), [])]


def header_fault(names: list[str], schema: StructType) -> str | None:
    """Why a header cannot serve the schema, or None."""
    missing = [c for c in schema.names if c not in names]
    if missing:
        return f"header lacks {', '.join(missing)}"
    twice = sorted({c for c in schema.names if names.count(c) > 1})
    return f"header repeats {', '.join(twice)}" if twice else None


def _fields(line: Column) -> Column:
    """The number of fields of a line: separators outside of quotes, and one."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    return F.char_length(bare) - F.char_length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def read_checked_csv(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of the headed CSV files under ``path``: rows with the columns of ``schema``, and
    rejects as file, line and reason.

    A line is a reject when it has another number of fields than its header, or a value that its column's
    type cannot hold; an empty field is NULL. The files with one header are read by one scan.
    """
    by_header: dict[str, list[str]] = {}
    for row in header_lines(spark, path).toLocalIterator():
        by_header.setdefault(row["header"], []).append(row["file"])
        if len(by_header) > MAX_HEADERS:
            raise ValueError(f"the files under {path} have more than {MAX_HEADERS} different headers")
    rows = spark.createDataFrame([], schema)
    rejects = spark.createDataFrame([], REJECTS)
    file = F.col("_metadata.file_path").alias("file")
    for header, files in sorted(by_header.items()):
        names = header_names(header)
        fault = header_fault(names, schema)
        if fault:
            lines = spark.read.text(files).filter(F.col("value") != header)
            rejects = rejects.unionByName(lines.select(file, F.col("value").alias("line"), F.lit(fault).alias("reason")))
            continue
        # columns the schema does not have are read as text under names of their own and left out
        fields = [schema[n] if n in schema.names else StructField(f"__extra{i}", StringType()) for i, n in enumerate(names)]
        wide = StructType([*fields, StructField(LINE, StringType())])
        parsed = spark.read.schema(wide).csv(files, header=True, enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord=LINE)
        # A scan reads no more columns than are asked for and finds no fault in the others, so every
        # condition asks for all of them, in a way that is always true.
        looked = F.xxhash64(*[f.name for f in fields]) >= F.lit(-(1 << 63))
        rows = rows.unionByName(parsed.filter(F.col(LINE).isNull() & looked).select(*schema.names))
        found = _fields(F.col(LINE))
        reason = F.when(found != len(names), F.concat(F.lit("fields: "), found)).otherwise(F.lit("a value does not fit its type"))
        broken = parsed.filter(F.col(LINE).isNotNull() & looked).select(file, F.col(LINE).alias("line"), reason.alias("reason"))
        rejects = rejects.unionByName(broken)
    return rows, rejects
