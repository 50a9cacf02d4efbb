"""Keep tables of a provider in good shape."""

from __future__ import annotations

from pyspark.sql import SparkSession

from statelake.sources.tables import maintenance_sql, provider_supports_calls


def maintain_provider_table(spark: SparkSession, catalog: str, table: str, older_than: str) -> None:
    """Compaction, snapshot expiry and orphan removal by the provider's own procedures."""
    if not provider_supports_calls(spark, catalog):
        raise RuntimeError(f"catalog {catalog} is not configured in this session")
    for statement in maintenance_sql(catalog, table, older_than):
        spark.sql(statement)
