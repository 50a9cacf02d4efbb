"""statelake: event logs to current-state and daily-KPI tables, as plain PySpark.

Layers
------
``functions``   column expressions (clocks, ids, counters)
``operators``   DataFrame -> DataFrame transforms, no I/O
``sources``     readers, writers and table layouts (log, CSV, Parquet, catalog, snapshots)
``plans``       the composed jobs: ingest, state, summary, sample, profile, upkeep
``streaming``   the same transforms driven by Structured Streaming
``registry``    named queries over the test tables and the SQL they must equal
"""

from statelake.plans.gold import daily_order_summary, refresh_gold
from statelake.plans.ingest import ingest_bronze
from statelake.plans.profile import profile_table
from statelake.plans.sample import stratified_orders
from statelake.plans.silver import (
    INGESTION_RULES,
    OFFSET_RULES,
    SilverRules,
    current_state,
    prepare_silver,
    refresh_silver,
)
from statelake.operators.lifecycle import lifecycle_events
from statelake.operators.merge import merge_rows
from statelake.session import build_session, catalog_conf, engine_conf

__all__ = [
    "INGESTION_RULES",
    "OFFSET_RULES",
    "SilverRules",
    "build_session",
    "catalog_conf",
    "current_state",
    "daily_order_summary",
    "engine_conf",
    "ingest_bronze",
    "lifecycle_events",
    "merge_rows",
    "prepare_silver",
    "profile_table",
    "refresh_gold",
    "refresh_silver",
    "stratified_orders",
]
