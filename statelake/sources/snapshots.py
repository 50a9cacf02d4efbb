"""Keyed tables on plain Parquet, for sessions without a provider that has row-level writes.

A commit writes only the partitions it changes, below ``data/commit=<token>/``, and then a manifest
listing, for every partition of the table, the commit that holds it. Files are never changed, so a
running reader keeps what it opened, and a commit that dies before its manifest leaves only
unreferenced files. One writer at a time is assumed. A second one fails when it publishes where the
file system renames exclusively; an object store does not, and needs a lock from outside.

This is a directory, a pointer and the rewriting of touched days, and no more: histories, expiry and
compaction are left to table providers.

A table with a ``key`` keeps every file sorted by it and with Bloom filters on it. An upsert of few
keys then looks them up by value: row groups whose value range or filter rules them out are not read.

A table with ``count_by`` writes, before each upsert is committed, by how much that upsert changes the
row counts of every group, under the number of the commit. Tables of such counts are kept up to date
from these small files alone. A file whose commit never came is overwritten by the next one's.

A commit on behalf of a stream's micro-batch names the stream and the batch in its manifest, so the
batch counts as taken in exactly when its data does.

The manifest has one row per partition value (days, for the tables here) and is the only thing that
passes through the driver; ``MAX_PARTITIONS`` bounds it.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Collection, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, LongType, StructField, StructType

from statelake.operators.merge import changed_rows, replace_rows
from statelake.operators.summary import count_changes
from statelake.session import input_bytes, materialized
from statelake.sources.paths import child_names, delete, publish_text, read_text

MAX_PARTITIONS = 100_000
# Keys of a source written in no more bytes than this filter the table by broadcast.
FEW_BYTES = 64 * 1024 * 1024
# Up to so many keys are looked up by value; more are joined.
FEW_KEYS = 512
# Small row groups let a lookup skip more; the Bloom filter of each is as large as its keys need, at most this.
ROW_GROUP_BYTES = 32 * 1024 * 1024
BLOOM_BYTES = 1024 * 1024
PARTITION_TYPES = (DateType, IntegralType)
_IN_PUSHED = "spark.sql.parquet.pushdown.inFilterThreshold"
_NULL_VALUE = "__HIVE_DEFAULT_PARTITION__"
_WHOLE = ""


def _null_last(value: object) -> tuple[bool, str]:
    return value is None, str(value)


@dataclass(frozen=True)
class Batch:
    """A micro-batch: the stream's lasting id, and the number, which a repeated batch has again."""

    stream: str
    number: int


@dataclass(frozen=True)
class SnapshotTable:
    """Where a table lives and what it looks like; ``key`` is the column that lookups go by, ``count_by``
    the groups whose counts the changes are written for."""

    root: str
    schema: StructType
    partition_by: str | None = None
    key: str | None = None
    row_group_bytes: int = ROW_GROUP_BYTES
    count_by: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.partition_by and not isinstance(self.schema[self.partition_by].dataType, PARTITION_TYPES):
            raise ValueError("partition by a date or whole-number column, whose values are plain directory names")

    # -- reading -------------------------------------------------------------------------------

    def _commits(self, spark: SparkSession) -> list[int]:
        names = [n.removesuffix(".json") for n in child_names(spark, f"{self.root}/manifest") if n.endswith(".json")]
        return [int(n) for n in names if n.isdigit()]

    def exists(self, spark: SparkSession) -> bool:
        return bool(self._commits(spark))

    def version(self, spark: SparkSession) -> int:
        """The number of the last commit, 0 before the first."""
        return max(self._commits(spark), default=0)

    def manifest(self, spark: SparkSession) -> dict[str, str]:
        """Partition value to commit token; empty before the first commit."""
        return self._last_manifest(spark)["partitions"]

    def batches(self, spark: SparkSession) -> dict[str, int]:
        """The last micro-batch taken in from every stream."""
        return self._last_manifest(spark)["batches"]

    def _last_manifest(self, spark: SparkSession) -> dict[str, dict]:
        known = self._commits(spark)
        content = json.loads(read_text(spark, self._manifest_path(known[-1]))) if known else {}
        if not isinstance(content.get("partitions"), dict):  # a table from before batches were named
            return {"partitions": content, "batches": {}}
        return content

    def read(self, spark: SparkSession, partitions: Collection[object] | None = None) -> DataFrame:
        """The table as last committed. With ``partitions`` only those are listed and scanned."""
        entries = self.manifest(spark)
        if partitions is not None:
            wanted = {self._text(value) for value in partitions}
            entries = {part: token for part, token in entries.items() if part in wanted}
        if not entries:
            return spark.createDataFrame([], self.schema)
        paths = [self._path(token, part) for part, token in sorted(entries.items())]
        reader = spark.read.schema(self.schema).option("basePath", f"{self.root}/data")
        return reader.parquet(*paths).select(*self.schema.names)

    # -- notes of changed partitions, kept until a table built on this one has taken them in -------

    def note_changes(self, spark: SparkSession, values: Collection[object] | None) -> None:
        """Note partitions that are about to change; None stands for all of them."""
        parts = None if values is None else sorted(self._text(v) for v in values)
        publish_text(spark, f"{self.root}/noted/{uuid.uuid4().hex}.json", json.dumps(parts))

    def noted_changes(self, spark: SparkSession) -> tuple[list[str], set[object] | None]:
        """The names of all notes, and the partitions they name together; None when it is all of them."""
        names = [n for n in child_names(spark, f"{self.root}/noted") if n.endswith(".json")]
        noted = [json.loads(read_text(spark, f"{self.root}/noted/{n}")) for n in names]
        if any(parts is None for parts in noted):
            return names, None
        return names, set(self.values({part for parts in noted for part in parts}))

    def drop_notes(self, spark: SparkSession, names: Collection[str]) -> None:
        for name in names:
            delete(spark, f"{self.root}/noted/{name}")

    # -- changes of counts, by commit ----------------------------------------------------------------

    def write_count_changes(self, changed: DataFrame, removed: DataFrame | None) -> None:
        """For the commit that comes next."""
        number = 1 + self.version(changed.sparkSession)
        changes = count_changes(changed, removed, self.count_by)
        changes.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/counts/{number:010d}")

    def count_changes_since(self, spark: SparkSession, version: int) -> DataFrame | None:
        """The changes of all commits after ``version``; None when any of them left none."""
        there = set(child_names(spark, f"{self.root}/counts"))
        wanted = [f"{n:010d}" for n in self._commits(spark) if n > version]
        fields = [*(self.schema[c] for c in self.count_by), StructField("change", LongType())]
        if not set(wanted) <= there:
            return None
        if not wanted:
            return spark.createDataFrame([], StructType(fields))
        return spark.read.schema(StructType(fields)).parquet(*[f"{self.root}/counts/{n}" for n in wanted])

    def drop_count_changes(self, spark: SparkSession, version: int) -> None:
        """Those of the commits up to ``version``."""
        for name in child_names(spark, f"{self.root}/counts"):
            if name.isdigit() and int(name) <= version:
                delete(spark, f"{self.root}/counts/{name}")

    # -- writing -------------------------------------------------------------------------------

    def replace(self, df: DataFrame, counted: bool = False, batch: Batch | None = None) -> list[str]:
        """Make ``df`` the whole content of the table; returns the partitions written.

        ``counted`` says that the changes of counts were written for this commit, ``batch`` names the
        micro-batch it takes in.
        """
        return self._commit(df, {}, counted, batch)

    def replace_partitions(
        self, df: DataFrame, touched: Collection[object], counted: bool = False, batch: Batch | None = None
    ) -> list[str]:
        """Replace the ``touched`` partitions by the rows of ``df``; one that gets no rows is dropped."""
        gone = {self._text(value) for value in touched}
        keep = {p: t for p, t in self.manifest(df.sparkSession).items() if p not in gone}
        return self._commit(df, keep, counted, batch)

    def values(self, parts: Collection[str]) -> list[object]:
        """Partition values of partition names, NULL last."""
        if self.partition_by is None:
            return list(parts)
        convert = dt.date.fromisoformat if isinstance(self.schema[self.partition_by].dataType, DateType) else int
        typed = [None if part == _NULL_VALUE else convert(part) for part in parts]
        return sorted(typed, key=_null_last)

    def _commit(self, df: DataFrame, keep: dict[str, str], counted: bool, batch: Batch | None) -> list[str]:
        spark = df.sparkSession
        version = 1 + self.version(spark)
        if self.count_by and not counted:  # those of a commit that never came are not this one's
            delete(spark, f"{self.root}/counts/{version:010d}")
        token = f"c{uuid.uuid4().hex}"
        target = f"{self.root}/data/commit={token}"
        rows = df.select(*self.schema.names)
        if self.partition_by:
            # The rebalance hint gathers small partitions into full files and, unlike a plain
            # repartition, lets adaptive execution split a day that holds most of the rows.
            self._writer(rows.hint("rebalance", self.partition_by)).partitionBy(self.partition_by).parquet(target)
            prefix = f"{self.partition_by}="
            written = [n.removeprefix(prefix) for n in child_names(spark, target) if n.startswith(prefix)]
        else:
            self._writer(rows.hint("rebalance")).parquet(target)
            written = [_WHOLE]
        entries = {**keep, **{part: token for part in written}}
        if len(entries) > MAX_PARTITIONS:
            delete(spark, target)
            raise ValueError(f"{self.root} would have more than {MAX_PARTITIONS} partitions")
        batches = self.batches(spark) | ({batch.stream: batch.number} if batch else {})
        content = {"partitions": entries, "batches": batches}
        publish_text(spark, self._manifest_path(version), json.dumps(content, indent=0, sort_keys=True))
        return written

    def _writer(self, rows: DataFrame) -> DataFrameWriter:
        if self.key is None:
            return rows.write
        order = [c for c in (self.partition_by, self.key) if c]
        # Setting names of the Parquet writer.
        options = {
            f"parquet.bloom.filter.enabled#{self.key}": "true",
            "parquet.bloom.filter.adaptive.enabled": "true",
            "parquet.bloom.filter.max.bytes": str(BLOOM_BYTES),
            "parquet.block.size": str(self.row_group_bytes),
        }
        return rows.sortWithinPartitions(*order).write.options(**options)

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifest/{version:010d}.json"

    def _text(self, value: object) -> str:
        return _NULL_VALUE if value is None else str(value)

    def _path(self, token: str, part: str) -> str:
        base = f"{self.root}/data/commit={token}"
        return f"{base}/{self.partition_by}={part}" if self.partition_by else base


def upsert(
    table: SnapshotTable,
    source: DataFrame,
    keys: list[str],
    guard: str | None = None,
    update_columns: list[str] | None = None,
    delete_missing_in: Collection[object] | None = None,
    delete_column: str | None = None,
    unique_source: bool = False,
    note_changes: bool = False,
    batch: Batch | None = None,
) -> list[object]:
    """Merge ``source`` into ``table``; returns the partition values whose rows changed.

    A ``batch`` that is committed already, or an earlier one of its stream, changes nothing, whatever
    the guard lets through.

    A table without a partition column counts as one partition, named ``""``.

    The source is written to the shared folder once, since it is read more than once and is usually
    the outcome of a large scan. The changed rows are then worked out against a narrow scan of the
    table and written likewise. They name the partitions to rewrite: the day each row moves to and
    the day it leaves. All other partitions are carried over by the manifest alone, so a run costs
    what its increment touches, and a run that changes nothing writes nothing.

    ``delete_missing_in`` lists values of ``delete_column`` (the partition column, if there is one)
    for which target rows without a source row are removed. ``note_changes`` notes the partitions
    beside the table before they are rewritten.
    """
    delete_column = delete_column or table.partition_by
    if delete_missing_in and (delete_column is None or table.partition_by not in (None, delete_column)):
        raise ValueError("rows can be removed by the partition column, or by any column of an unpartitioned table")
    spark = source.sparkSession
    if batch and table.batches(spark).get(batch.stream, -1) >= batch.number:
        return []
    if not table.exists(spark):
        if note_changes:
            table.note_changes(spark, None)
        # nothing to find or keep: every row is an insert, written in one pass
        empty = spark.createDataFrame([], table.schema)
        return table.values(table.replace(changed_rows(empty, source, keys, guard, update_columns, None, unique_source), batch=batch))
    with materialized(source, "source") as fixed:
        few = input_bytes(fixed) <= FEW_BYTES
        values = few_values(fixed, table.key) if few and table.key in keys else None
        with looked_up(table.read(spark), table.key, values) as current:
            changes = changed_rows(
                current, fixed, keys, guard, update_columns, table.partition_by, unique_source, few, table.count_by
            )
            with materialized(changes, "changes") as changed:
                return _apply(table, fixed, changed, keys, set(delete_missing_in or ()), delete_column, note_changes, batch)


def few_values(df: DataFrame, column: str, most: int = FEW_KEYS) -> list[object] | None:
    """The distinct values of ``column`` but NULL, or None when there are more than ``most``."""
    rows = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(most + 1).collect()
    return None if len(rows) > most else [row[0] for row in rows]


@contextmanager
def looked_up(df: DataFrame, column: str | None, values: list[object] | None) -> Iterator[DataFrame]:
    """The rows of ``df`` whose ``column`` is one of ``values``; all rows when these are None.

    While the block runs, the values reach the Parquet reader one by one. Spark would push down
    no more than their range if there are more than a handful.
    """
    if values is None:
        yield df
        return
    spark = df.sparkSession
    before = spark.conf.get(_IN_PUSHED)
    spark.conf.set(_IN_PUSHED, str(max(int(before), len(values))))
    try:
        yield df.filter(F.col(column).isin(values) if values else F.lit(False))
    finally:
        spark.conf.set(_IN_PUSHED, before)


def _apply(
    table: SnapshotTable,
    source: DataFrame,
    changed: DataFrame,
    keys: list[str],
    doomed_values: set[object],
    delete_column: str | None,
    note_changes: bool,
    batch: Batch | None,
) -> list[object]:
    spark = source.sparkSession
    by = table.partition_by
    if by is None:
        touched = {_WHOLE} if doomed_values or not changed.isEmpty() else set()
    else:
        touched = _touched_partitions(changed, by) | doomed_values
    if not touched:
        return []
    if note_changes:
        table.note_changes(spark, touched if by else None)
    target = table.read(spark, partitions=touched if by else None)
    removed = None
    if doomed_values:
        doomed = F.coalesce(F.col(delete_column).isin([v for v in doomed_values if v is not None]), F.lit(False))
        if None in doomed_values:
            doomed = doomed | F.col(delete_column).isNull()
        present = target.filter(doomed).join(source.select(*keys), keys, "left_semi")
        removed = target.filter(doomed).join(source.select(*keys), keys, "left_anti")
        target = target.filter(~doomed).unionByName(present.select(*target.columns))
    if table.count_by:
        table.write_count_changes(changed, removed)
    merged = replace_rows(target, changed, keys)
    if by is None:
        table.replace(merged, counted=True, batch=batch)
    else:
        table.replace_partitions(merged, touched, counted=True, batch=batch)
    return sorted(touched, key=_null_last)


def _touched_partitions(changed: DataFrame, by: str) -> set[object]:
    places = changed.select(F.col(by).alias("place"))
    left = changed.filter("__updated").select(F.col(f"__old_{by}").alias("place"))
    rows = places.unionByName(left).distinct().limit(MAX_PARTITIONS + 1).collect()
    if len(rows) > MAX_PARTITIONS:
        raise ValueError(f"the change touches more than {MAX_PARTITIONS} partitions")
    return {row["place"] for row in rows}
