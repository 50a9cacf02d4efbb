"""Records that could not enter the state, kept until they can.

A reject is a raw row with a reason, an id, the number of tries and a state: ``open``, ``mended`` or
``given_up``. A retry hands all open ones to a caller's function; those it mends enter the state table
as one batch, and every reject's outcome is committed afterwards. The batch is named by the version of
the reject table, and what the function made of it is written before it is used, so a retry that dies
in between does the very same again and the state table takes the batch once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from statelake.functions.clocks import parse_timestamp, seconds_between
from statelake.plans.silver import OFFSET_RULES, SilverRules, refresh_silver, rejected_records
from statelake.schemas import BRONZE_SCHEMA, CORRUPT_COLUMN, EVENT_SCHEMA
from statelake.session import sized
from statelake.sources.paths import child_names, delete
from statelake.sources.snapshots import Batch, SnapshotTable, upsert

OPEN, MENDED, GIVEN_UP = "open", "mended", "given_up"
ID, REASON, TRIES, STATE = "reject_id", "reject_reason", "tries", "state"
REJECT_SCHEMA = StructType(
    [
        StructField(ID, StringType()),
        *BRONZE_SCHEMA.fields,
        StructField(REASON, StringType()),
        StructField(TRIES, IntegerType()),
        StructField(STATE, StringType()),
    ]
)


def reject_table(path: str) -> SnapshotTable:
    return SnapshotTable(path, REJECT_SCHEMA, key=ID)


def reject_id(columns: list[str]) -> Column:
    """The record's place in the log, which a record that is taken in again has again, and its content."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def keep_rejects(spark: SparkSession, bronze: DataFrame, table: SnapshotTable, rules: SilverRules = OFFSET_RULES) -> None:
    """Store the rows of ``bronze`` that ``refresh_silver`` leaves out. One that is stored already keeps
    its tries and state, so a raw layer may be gone over again."""
    place = ["topic", "partition", "offset", CORRUPT_COLUMN, *EVENT_SCHEMA.names]
    found = rejected_records(bronze, rules).withColumn(ID, reject_id(place)).dropDuplicates([ID])
    rows = found.withColumn(TRIES, F.lit(0)).withColumn(STATE, F.lit(OPEN)).select(*REJECT_SCHEMA.names)
    with sized(spark, bronze, paths=(table.root,)):
        upsert(table, rows, [ID], guard="FALSE", unique_source=True)


def decoded_again(rejects: DataFrame, text: Column) -> DataFrame:
    """``rejects`` whose payload was broken, read from the mended ``text`` instead; others as they are."""
    wide = StructType(EVENT_SCHEMA.fields + [StructField(CORRUPT_COLUMN, StringType())])
    payload = F.from_json(text, wide, {"columnNameOfCorruptRecord": CORRUPT_COLUMN})
    broken = F.col(CORRUPT_COLUMN).isNotNull()
    read = rejects.withColumn("__payload", F.when(broken, payload))
    fields = {c: F.when(F.col("__payload").isNotNull(), F.col("__payload")[c]).otherwise(F.col(c)) for c in wide.names}
    return read.withColumns(fields).drop("__payload")


def retry_rejects(
    spark: SparkSession,
    table: SnapshotTable,
    mend: Callable[[DataFrame], DataFrame],
    silver: SnapshotTable,
    rules: SilverRules = OFFSET_RULES,
    as_of: dt.datetime | str | Column | None = None,
    history: DataFrame | None = None,
    most_tries: int = 3,
) -> list[object]:
    """Let ``mend`` work on the open rejects and merge those it mended into ``silver``; returns the days
    whose rows changed.

    ``mend`` gets and returns rows of the reject table; it may change any event field and may leave out
    rows. Rejects that still cannot be used count one try more and are given up after ``most_tries``.
    ``rules`` and ``history`` are as for ``refresh_silver``: the mended rows are an increment.
    """
    version = table.version(spark)
    batch = Batch(f"rejects {table.root}", version)
    waiting = table.read(spark).filter(F.col(STATE) == OPEN)
    if waiting.isEmpty():
        return []
    path = f"{table.root}/tries/{version:010d}"
    if "_SUCCESS" not in child_names(spark, path):
        mended = mend(waiting).select(*REJECT_SCHEMA.names)
        stamped = mended.withColumn("ingestion_timestamp", parse_timestamp("ingestion_time")).withColumn(
            "lag_sec", seconds_between("processing_time", "ingestion_timestamp")
        )
        told = stamped.withColumn(REASON, rules.rejects)
        told.select(*REJECT_SCHEMA.names).write.mode("overwrite").parquet(path)
    tried = spark.read.schema(REJECT_SCHEMA).parquet(path)
    usable = tried.filter(F.col(REASON).isNull())
    days = refresh_silver(spark, usable.select(*BRONZE_SCHEMA.names), silver, rules, as_of, history, batch)

    still = waiting.join(tried.select(ID), ID, "left_anti").unionByName(tried.filter(F.col(REASON).isNotNull()))
    missed = still.withColumn(TRIES, F.col(TRIES) + 1).withColumn(STATE, F.when(F.col(TRIES) >= most_tries, GIVEN_UP).otherwise(OPEN))
    done = usable.withColumn(TRIES, F.col(TRIES) + 1).withColumn(STATE, F.lit(MENDED)).withColumn(REASON, F.lit(None).cast("string"))
    outcome = missed.select(*REJECT_SCHEMA.names).unionByName(done.select(*REJECT_SCHEMA.names))
    upsert(table, outcome, [ID], unique_source=True)
    delete(spark, path)
    return days
