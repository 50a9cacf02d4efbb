"""Catalog tables: namespaces, DDL, introspection, and MERGE through a provider that supports it."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Properties of the state table (row-level changes are written beside the data files)
# and of the summary table, which is small and rewritten in place.
SILVER_PROPERTIES = {
    "format-version": "2",
    "write.update.mode": "merge-on-read",
    "write.merge.mode": "merge-on-read",
    "write.delete.mode": "merge-on-read",
    "write.target-file-size-bytes": "134217728",
}
GOLD_PROPERTIES = {
    "format-version": "2",
    "write.target-file-size-bytes": "134217728",
}


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")


def table_ddl(
    name: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    provider: str = "iceberg",
    properties: Mapping[str, str] | None = None,
) -> str:
    """An idempotent ``CREATE TABLE`` statement."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)
    parts = [f"CREATE TABLE IF NOT EXISTS {name} ({columns})", f"USING {provider}"]
    if partition_by:
        parts.append("PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")")
    if properties:
        parts.append("TBLPROPERTIES (" + ", ".join(f"'{k}' = '{v}'" for k, v in properties.items()) + ")")
    return "\n".join(parts)


def create_table(spark: SparkSession, name: str, schema: StructType, **options) -> None:
    spark.sql(table_ddl(name, schema, **options))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {namespace}")


def table_properties(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW TBLPROPERTIES {name}")


def table_columns(spark: SparkSession, name: str) -> DataFrame:
    """Column names and types of a table, in order."""
    fields = spark.table(name).schema.fields
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(fields)]
    return spark.createDataFrame(rows, "position int, column string, type string, nullable boolean")


def merge_sql(
    table: str,
    view: str,
    keys: Sequence[str],
    columns: Sequence[str],
    guard: str | None = None,
    update_columns: Sequence[str] | None = None,
    delete_missing: bool = False,
) -> str:
    """The ``MERGE`` statement with the same meaning as ``operators.merge.merge_rows``."""
    updates = [c for c in (update_columns or columns) if c not in keys]
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    matched = "WHEN MATCHED" + (f" AND {guard}" if guard else "")
    lines = [
        f"MERGE INTO {table} AS t",
        f"USING {view} AS s",
        f"ON {on}",
        f"{matched} THEN UPDATE SET " + ", ".join(f"t.{c} = s.{c}" for c in updates),
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) VALUES ({', '.join(f's.{c}' for c in columns)})",
    ]
    if delete_missing:
        lines.append("WHEN NOT MATCHED BY SOURCE THEN DELETE")
    return "\n".join(lines)


@contextmanager
def named(df: DataFrame) -> Iterator[str]:
    """A name under which SQL can use ``df`` inside the block; no two are alike."""
    view = f"statelake_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        yield view
    finally:
        df.sparkSession.catalog.dropTempView(view)


def merge_into(table: str, source: DataFrame, keys: Sequence[str], **options) -> None:
    """Merge through the table's provider, which plans the row-level write itself."""
    with named(source) as view:
        source.sparkSession.sql(merge_sql(table, view, keys, source.columns, **options))


def maintenance_sql(catalog: str, table: str, older_than: str) -> list[str]:
    """Provider procedures for compaction, snapshot expiry and orphan removal."""
    return [
        f"CALL {catalog}.system.rewrite_data_files(table => '{table}')",
        f"CALL {catalog}.system.expire_snapshots(table => '{table}', older_than => TIMESTAMP '{older_than}')",
        f"CALL {catalog}.system.remove_orphan_files(table => '{table}', older_than => TIMESTAMP '{older_than}')",
    ]


def provider_supports_calls(spark: SparkSession, catalog: str) -> bool:
    """Whether ``catalog`` is configured as a provider catalog in this session."""
    return bool(spark.conf.get(f"spark.sql.catalog.{catalog}", ""))
