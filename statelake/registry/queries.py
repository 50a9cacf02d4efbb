"""Named queries, one or more per operator. Each takes a session and a folder of tables and reads
those tables whole."""

from __future__ import annotations

import datetime as dt
import functools
import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statelake.functions.clocks import iso_naive, iso_zoned, parse_timestamp, seconds_between
from statelake.functions.identity import stable_id
from statelake.operators import profile as prof
from statelake.operators.envelope import decode, encode, reject_reason, stamp_event
from statelake.operators.latest import dedup_newest, drop_copies, latest_by
from statelake.operators.lifecycle import ORDER_STAGES, cancelled_stage, lifecycle_events, unpivot_stages
from statelake.operators.merge import and_changed, merge_rows, not_older
from statelake.operators.offsets import advance_offsets, next_offsets, resume
from statelake.operators.sampling import child_rows, stratified_sample
from statelake.operators.summary import cancellation_rate, daily_revenue, daily_summary, delivery_time
from statelake.operators.fingerprint import compare
from statelake.operators.sketches import distinct_by, standard_error
from statelake.plans.audit import add_to_sketches, audit_layers, sketch_table, state_fingerprints
from statelake.plans.gold import COUNTED_BY, counts_table, daily_order_summary, gold_table, refresh_gold, refresh_gold_by_changes
from statelake.plans.ingest import ingest_bronze, offset_table, to_bronze
from statelake.plans.profile import profile_table
from statelake.plans.rejects import decoded_again, keep_rejects, reject_table, retry_rejects
from statelake.plans.sample import write_sampled_orders
from statelake.plans.silver import (
    INGESTION_RULES,
    OFFSET_RULES,
    SilverRules,
    changed_orders,
    current_state,
    latest_events,
    latest_of_changed,
    prepare_silver,
    refresh_silver,
    silver_table,
    to_state_rows,
)
from statelake.registry import inputs
from statelake.registry.inputs import PROCESSED_AT, as_text, deliveries, plain, single_events, table, wide_orders
from statelake.schemas import EVENT_FIELDS, GOLD_SCHEMA, LOG_SCHEMA, SILVER_SCHEMA
from statelake.session import begin_query, bounded_tasks, scratch_path
from statelake.sources import tables
from statelake.sources.checked_csv import read_checked_csv
from statelake.sources.files import read_bronze, read_csv, write_csv
from statelake.sources.snapshots import Batch, upsert
from statelake.streaming.bronze import stream_bronze
from statelake.streaming.copies import stream_events
from statelake.streaming.latest import LATEST_RULES, changed_state, merge_changed_state, stream_latest
from statelake.streaming.silver import STREAM_RULES, stream_silver

Query = Callable[[SparkSession, str], DataFrame]
FOLD_RULES = SilverRules(copies="fold")
SAMPLE_CAPS = {"F": 500, "O": 70, "P": 2_000_000}
CHILD_CAPS = {"F": 500, "O": 70}
# Each event is delivered once to three times; a file of the streamed log holds the records of so many.
MICRO_BATCHES, EVENTS_PER_FILE = 4, 50_000
FIRST_RUN, SECOND_RUN = "2024-02-01 00:00:00", "2024-02-02 00:00:00"
FIRST_RUN_AT, SECOND_RUN_AT = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)

_registered: dict[str, Query] = {}


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        begin_query(spark)  # no shuffle width of the query before
        return fn(spark, folder)

    _registered[fn.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_registered)


# -- decoding, typing, lags ------------------------------------------------------------------------


@query
def json_decode(spark, folder):
    events = table(spark, folder, "events")
    return events.select("event_id", "event_type", F.from_json("props", "k int").alias("p")).select(
        "event_id", "event_type", "p.k"
    )


@query
def envelope_roundtrip(spark, folder):
    return decode(inputs.log(spark, folder)).select(*EVENT_FIELDS, "topic", "partition", "offset")


@query
def ingest_partitions(spark, folder):
    ts = F.col("ts").cast("timestamp")
    return table(spark, folder, "events").select(
        "event_id", F.to_date(ts).alias("raw_date"), F.hour(ts).alias("raw_hour")
    )


@query
def ingestion_lag(spark, folder):
    text = as_text(deliveries(spark, folder))
    typed = text.withColumn("ingestion_time", parse_timestamp("ingestion_time")).withColumn(
        "event_time", parse_timestamp("event_time")
    )
    return typed.select(
        "offset",
        seconds_between("ingestion_time", "event_time").alias("ingestion_lag_sec"),
        seconds_between(F.lit(PROCESSED_AT).cast("timestamp"), "ingestion_time").alias("processing_lag_sec"),
        F.to_date("event_time").alias("event_date"),
    )


@query
def bronze_rows(spark, folder):
    return plain(inputs.bronze(spark, folder)).select(
        "event_id", "order_id", "partition", "offset", "kafka_timestamp", "processing_time",
        "ingestion_timestamp", "lag_sec", "raw_date", "raw_hour",
    )


def _damaged_log(spark, folder):
    """The log with several kinds of broken payload, by event number."""
    events = as_text(single_events(spark, folder))
    kind = F.col("number") % 11
    events = (
        events.withColumn("event_time", F.when(kind == 3, "junk").otherwise(F.col("event_time")))
        .withColumn("order_id", F.when(kind != 2, F.col("order_id")))
        .withColumn("event_id", F.when(kind != 4, F.col("event_id")))
    )
    value = (
        F.when(kind == 0, F.lit("not json"))
        .when(kind == 1, F.lit("{}"))
        .when(kind == 5, F.lit(None))
        .otherwise(F.to_json(F.struct(*EVENT_FIELDS)))
    )
    return events.select(
        value.cast("binary").alias("value"), "topic", "partition", "offset", F.col("ingestion_time").alias("timestamp")
    )


@query
def quarantine_split(spark, folder):
    decoded = decode(_damaged_log(spark, folder), corrupt_column="corrupt_record")
    return decoded.select("offset", reject_reason().alias("reject_reason"), "corrupt_record")


# -- deduplication and latest state ----------------------------------------------------------------


@query
def dedup_latest_ingestion(spark, folder):
    kept = dedup_newest(deliveries(spark, folder))
    return plain(kept.select("event_id", "order_id", "ingestion_time", "offset"))


@query
def drop_duplicates_keys(spark, folder):
    return drop_copies(deliveries(spark, folder).select("event_id", "order_id")).select("event_id")


@query
def silver_input(spark, folder):
    prepared = prepare_silver(inputs.bronze(spark, folder))
    return plain(prepared.select(
        "event_id", "order_id", "event_type", "event_time", "ingestion_time", "ingestion_lag_sec", "event_date"
    ))


def _state_columns(df):
    return plain(df.select("order_id", "event_id", "event_type", "event_time", "ingestion_time", "offset"))


@query
def latest_state(spark, folder):
    return _state_columns(latest_events(deliveries(spark, folder), OFFSET_RULES))


@query
def latest_state_single_pass(spark, folder):
    return _state_columns(latest_events(deliveries(spark, folder), FOLD_RULES))


@query
def latest_state_variant_b(spark, folder):
    return _state_columns(latest_events(deliveries(spark, folder), INGESTION_RULES))


@query
def latest_of_changed_orders(spark, folder):
    history = deliveries(spark, folder)
    orders = history.filter(F.col("event_type") == "CANCELLED").select("order_id").distinct()
    return _state_columns(latest_of_changed(history, orders, OFFSET_RULES))


@query
def silver_increment_with_history(spark, folder):
    """The orders that the second half of the log may change, ranked over all their events. Later
    copies of some events name another order than the first."""
    history = inputs.moved_deliveries(spark, folder)
    increment = history.filter("ingestion_time >= timestamp'2024-01-16'")
    return _state_columns(latest_of_changed(history, changed_orders(history, increment), OFFSET_RULES))


@query
def silver_projection(spark, folder):
    return plain(current_state(inputs.bronze(spark, folder), OFFSET_RULES, PROCESSED_AT))


@query
def silver_projection_variant_b(spark, folder):
    return plain(current_state(inputs.bronze(spark, folder), INGESTION_RULES, PROCESSED_AT))


# -- merge -----------------------------------------------------------------------------------------


def _merge_sides(spark, folder):
    """Two overlapping states: one of the early event types, one of the late ones; SHIPPED is in both."""
    events = deliveries(spark, folder)
    early = events.filter(F.col("event_type").isin("ORDER_CREATED", "PAYMENT_APPROVED", "SHIPPED"))
    late = events.filter(F.col("event_type").isin("SHIPPED", "DELIVERED", "CANCELLED"))
    target = to_state_rows(latest_events(early, FOLD_RULES), FOLD_RULES, FIRST_RUN)
    source = to_state_rows(latest_events(late, FOLD_RULES), FOLD_RULES, SECOND_RUN)
    return target, source


@query
def merge_guarded(spark, folder):
    target, source = _merge_sides(spark, folder)
    return plain(merge_rows(target, source, ["order_id"], not_older("event_time"), unique_source=True))


@query
def merge_unconditional(spark, folder):
    target, source = _merge_sides(spark, folder)
    return plain(merge_rows(target, source, ["order_id"]))


@query
def merge_skip_unchanged(spark, folder):
    target, source = _merge_sides(spark, folder)
    guard = and_changed(["event_id"], not_older("event_time"))
    return plain(merge_rows(target, source, ["order_id"], guard, unique_source=True))


@query
def gold_merge(spark, folder):
    """Days up to the 20th stored, days from the 11th coming in: some kept, some updated, some new."""
    target, source = _merge_sides(spark, folder)
    old = daily_order_summary(target, FIRST_RUN).filter("order_date <= date'2024-01-20'")
    new = daily_order_summary(source, SECOND_RUN).filter("order_date >= date'2024-01-11'")
    return plain(merge_rows(old, new, ["order_date"], unique_source=True))


# -- daily summary ---------------------------------------------------------------------------------


@query
def gold_daily_summary(spark, folder):
    state = to_state_rows(latest_events(deliveries(spark, folder), FOLD_RULES), FOLD_RULES, PROCESSED_AT)
    return daily_summary(state, with_other=True)


@query
def medallion_daily(spark, folder):
    """Log records to daily summary in one plan."""
    state = current_state(inputs.bronze(spark, folder), OFFSET_RULES, PROCESSED_AT)
    return plain(daily_order_summary(state, PROCESSED_AT))


@query
def medallion_daily_single_pass(spark, folder):
    """The same without a shuffle on the event id."""
    state = current_state(inputs.bronze(spark, folder), FOLD_RULES, PROCESSED_AT)
    return plain(daily_order_summary(state, PROCESSED_AT))


@query
def gold_ordered(spark, folder):
    return gold_daily_summary(spark, folder).select("order_date", "total_orders").orderBy("order_date")


@query
def kpi_revenue(spark, folder):
    return daily_revenue(
        table(spark, folder, "orders"), table(spark, folder, "lineitem"),
        "o_orderkey", "l_orderkey", "l_extendedprice", "o_orderdate",
    )


@query
def kpi_cancellation(spark, folder):
    return cancellation_rate(table(spark, folder, "orders"), "o_orderdate", "o_orderstatus", "O")


@query
def kpi_delivery_time(spark, folder):
    return delivery_time(wide_orders(spark, folder), "order_purchase_timestamp", "order_delivered_customer_date")


# -- log positions ---------------------------------------------------------------------------------


def _positions(spark, folder):
    """Positions after the first half of the month, with one partition that was silent then."""
    early = deliveries(spark, folder).filter("ingestion_time < timestamp'2024-01-16' AND partition <> 3")
    return next_offsets(early)


@query
def log_next_offsets(spark, folder):
    return next_offsets(deliveries(spark, folder))


@query
def log_resume(spark, folder):
    rest = resume(deliveries(spark, folder), _positions(spark, folder))
    return rest.select("topic", "partition", "offset")


@query
def log_resume_null_slots(spark, folder):
    """Records without topic or partition, resumed over a few positions and over more than fit a filter."""
    parts = []
    for slots in (4, 300):
        topic = F.when(F.col("offset") % 7 > 0, F.col("topic"))
        partition = F.when(F.col("offset") % 11 > 0, F.col("offset") % slots).cast("int")
        log = deliveries(spark, folder).withColumns({"topic": topic, "partition": partition})
        positions = next_offsets(log.filter("ingestion_time < timestamp'2024-01-16'"))
        parts.append(resume(log, positions).select(F.lit(slots).alias("slots"), "topic", "partition", "offset"))
    return parts[0].unionByName(parts[1])


@query
def log_advance(spark, folder):
    """Stored positions moved on by a batch in which one partition was silent."""
    seen = next_offsets(deliveries(spark, folder).filter("partition <> 1"))
    return advance_offsets(_positions(spark, folder), seen)


# -- orders: lifecycle, sample, profile ------------------------------------------------------------


@query
def lifecycle_unpivot(spark, folder):
    return plain(lifecycle_events(wide_orders(spark, folder)))


@query
def lifecycle_with_cancelled(spark, folder):
    stages = (*ORDER_STAGES, cancelled_stage("order_cancelled_at"))
    return plain(lifecycle_events(wide_orders(spark, folder), stages, order="none"))


@query
def lifecycle_records(spark, folder):
    """Lifecycle events as keyed log records with their three clocks, read back."""
    events = lifecycle_events(wide_orders(spark, folder), order="none")
    run = F.lit(PROCESSED_AT).cast("timestamp")
    return decode(encode(stamp_event(events, run, run)), metadata={})


@query
def orders_to_daily(spark, folder):
    """Wide orders all the way to the daily summary: events, records, raw rows, state, days."""
    events = unpivot_stages(wide_orders(spark, folder)).select(
        stable_id("order_id", "event_type").alias("event_id"),
        "order_id", "customer_id", "event_type",
        iso_naive("event_time").alias("original_event_time"),
        iso_zoned("event_time").alias("event_time"),
        iso_zoned("event_time").alias("ingestion_time"),
        "order_status",
        F.lit(inputs.TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("stage_rank").cast("long").alias("offset"),
        F.lit(PROCESSED_AT).cast("timestamp").alias("timestamp"),
    )
    raw = to_bronze(encode(events, keep=("topic", "partition", "offset", "timestamp")), PROCESSED_AT)
    return daily_summary(current_state(raw, FOLD_RULES, PROCESSED_AT))


def _sample(spark, folder, caps):
    return stratified_sample(table(spark, folder, "orders"), "o_orderstatus", caps, "o_orderkey")


@query
def stratified_orders(spark, folder):
    return _sample(spark, folder, SAMPLE_CAPS).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query
def child_semi_join(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    sample = _sample(spark, folder, CHILD_CAPS)
    return child_rows(lines, sample, "o_orderkey", "l_orderkey", sum(CHILD_CAPS.values()))


@query
def value_counts(spark, folder):
    return prof.value_counts(table(spark, folder, "customer"), "c_mktsegment", "customers")


@query
def state_counts(spark, folder):
    state = current_state(inputs.bronze(spark, folder), INGESTION_RULES, PROCESSED_AT)
    return prof.value_counts(state, "current_status", "order_count")


@query
def null_profile(spark, folder):
    return prof.null_counts(
        wide_orders(spark, folder),
        ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date"],
    )


@query
def distinct_count(spark, folder):
    return prof.distinct_count(table(spark, folder, "lineitem"), "l_orderkey", "distinct_orders")


@query
def row_count(spark, folder):
    return prof.row_count(table(spark, folder, "lineitem"), "line_count")


@query
def reconcile(spark, folder):
    return prof.reconcile(deliveries(spark, folder), "event_id")


@query
def top_k_recent(spark, folder):
    latest = latest_by(single_events(spark, folder), ["order_id"], ["event_time", "offset"])
    picked = latest.select("order_id", "event_type", "event_time", "offset")
    return plain(prof.top_rows(picked, [F.desc("event_time"), F.desc("offset")], 20))


# -- written tables --------------------------------------------------------------------------------


@query
def ingest_two_batches(spark, folder):
    """The log taken in by two runs, the second resuming where the first ended."""
    bronze_path, offsets_path = scratch_path(spark, "bronze"), scratch_path(spark, "offsets")
    whole = inputs.log(spark, folder)
    early = whole.filter("timestamp < timestamp'2024-01-16'")
    ingest_bronze(spark, early, bronze_path, offsets_path, FIRST_RUN_AT)
    ingest_bronze(spark, whole, bronze_path, offsets_path, SECOND_RUN_AT)
    landed = read_bronze(spark, bronze_path)
    return plain(landed.select("event_id", "partition", "offset", "lag_sec", "raw_date", "raw_hour"))


@query
def stored_offsets(spark, folder):
    """The same through an ingest run and its stored positions."""
    bronze_path, offsets_path = scratch_path(spark, "bronze"), scratch_path(spark, "offsets")
    offset_table(offsets_path).replace(_positions(spark, folder))
    ingest_bronze(spark, inputs.log(spark, folder).filter("partition <> 1"), bronze_path, offsets_path, FIRST_RUN_AT)
    return offset_table(offsets_path).read(spark)


@query
def silver_table_two_refreshes(spark, folder):
    """State table after a run over the early events and one over the late ones."""
    silver = silver_table(scratch_path(spark, "silver"))
    raw = inputs.bronze(spark, folder)
    early = raw.filter(F.col("event_type").isin("ORDER_CREATED", "PAYMENT_APPROVED", "SHIPPED"))
    late = raw.filter(F.col("event_type").isin("SHIPPED", "DELIVERED", "CANCELLED"))
    refresh_silver(spark, early, silver, FOLD_RULES, FIRST_RUN)
    refresh_silver(spark, late, silver, FOLD_RULES, SECOND_RUN)
    return plain(silver.read(spark))


@query
def gold_table_refresh(spark, folder):
    """Summary of the state table, first in full and then for the days a second run changed."""
    silver, gold = silver_table(scratch_path(spark, "silver")), gold_table(scratch_path(spark, "gold"))
    raw = inputs.bronze(spark, folder)
    refresh_silver(spark, raw.filter("event_type <> 'CANCELLED'"), silver, FOLD_RULES, FIRST_RUN)
    refresh_gold(spark, silver, gold, as_of=FIRST_RUN)
    days = refresh_silver(spark, raw.filter("event_type = 'CANCELLED'"), silver, FOLD_RULES, SECOND_RUN)
    refresh_gold(spark, silver, gold, days, SECOND_RUN, prune_missing=True)
    return gold.read(spark).drop("updated_at")


@query
def silver_table_last_hours(spark, folder):
    """State table after a run over the early kinds of events and one over the last half day, whose few
    orders are looked up by key as long as they are few."""
    silver = silver_table(scratch_path(spark, "silver"))
    raw = inputs.bronze(spark, folder)
    refresh_silver(spark, raw.filter(F.col("event_type").isin("ORDER_CREATED", "PAYMENT_APPROVED", "SHIPPED")), silver, FOLD_RULES, FIRST_RUN)
    last = raw.filter(F.col("original_event_time") >= "2024-01-30T12:00")
    refresh_silver(spark, last, silver, FOLD_RULES, SECOND_RUN)
    return plain(silver.read(spark))


@query
def gold_by_changes(spark, folder):
    """The summary kept up by counts of changed rows: orders move, some are removed, a run is repeated."""
    silver = silver_table(scratch_path(spark, "silver"), count_by=COUNTED_BY)
    counts, gold = counts_table(scratch_path(spark, "counts")), gold_table(scratch_path(spark, "gold"))
    raw = inputs.bronze(spark, folder)
    late = raw.filter("event_type = 'CANCELLED'")

    def summed(at):
        refresh_gold_by_changes(spark, silver, counts, gold, at, prune_missing=True)

    refresh_silver(spark, raw.filter("event_type <> 'CANCELLED'"), silver, FOLD_RULES, FIRST_RUN)
    summed(FIRST_RUN)
    refresh_silver(spark, late, silver, FOLD_RULES, SECOND_RUN)
    summed(SECOND_RUN)
    refresh_silver(spark, late, silver, FOLD_RULES, SECOND_RUN)  # the same events again
    last_day = dt.date(2024, 1, 30)
    left = silver.read(spark, partitions=[last_day]).filter("current_status <> 'CANCELLED'")
    upsert(silver, left, ["order_id"], delete_missing_in=[last_day], unique_source=True)
    summed(SECOND_RUN)
    return gold.read(spark).drop("updated_at")


@query
def gold_after_interrupted_run(spark, folder):
    """As ``gold_table_refresh``, but the second run dies between the two tables and is repeated."""
    rules = SilverRules(copies="fold", skip_unchanged=True)
    silver, gold = silver_table(scratch_path(spark, "silver"), rules), gold_table(scratch_path(spark, "gold"))
    raw = inputs.bronze(spark, folder)
    refresh_silver(spark, raw.filter("event_type <> 'CANCELLED'"), silver, rules, FIRST_RUN)
    refresh_gold(spark, silver, gold, as_of=FIRST_RUN)
    late = raw.filter("event_type = 'CANCELLED'")
    refresh_silver(spark, late, silver, rules, SECOND_RUN)  # its changed days are lost with the run
    days = refresh_silver(spark, late, silver, rules, SECOND_RUN)
    refresh_gold(spark, silver, gold, days, SECOND_RUN, prune_missing=True)
    return gold.read(spark).drop("updated_at")


@query
def ingest_nothing_new(spark, folder):
    """A second run over a log that has not grown writes no record and keeps the positions."""
    bronze_path, offsets_path = scratch_path(spark, "bronze"), scratch_path(spark, "offsets")
    whole = inputs.log(spark, folder)
    runs = [ingest_bronze(spark, whole, bronze_path, offsets_path, at) for at in (FIRST_RUN_AT, SECOND_RUN_AT)]
    landed = read_bronze(spark, bronze_path).groupBy("topic", "partition").agg(F.count("*").alias("records"))
    return offset_table(offsets_path).read(spark).join(landed, ["topic", "partition"]).withColumn(
        "written_twice", F.lit(all(run.written for run in runs))
    )


@query
def catalog_tables(spark, folder):
    """Namespace, tables and properties by DDL, filled from the summary and read back by name."""
    namespace = f"spark_catalog.q{uuid.uuid4().hex}"
    tables.create_namespace(spark, namespace)
    name = f"{namespace}.daily_order_summary"
    tables.create_table(
        spark, name, GOLD_SCHEMA, partition_by=["order_date"], provider="parquet", properties={"layer": "gold"}
    )
    state = to_state_rows(latest_events(deliveries(spark, folder), FOLD_RULES), FOLD_RULES, PROCESSED_AT)
    summary = daily_order_summary(state, PROCESSED_AT).select(*spark.table(name).columns)
    summary.write.insertInto(name)
    listed = tables.list_tables(spark, namespace).count()
    columns = tables.table_columns(spark, name).count()
    return tables.read_table(spark, name).select(
        "order_date", "total_orders", "delivered_orders", F.lit(listed).alias("tables"),
        (F.lit(columns) >= len(GOLD_SCHEMA)).alias("all_columns"),
    )


@query
def silver_catalog_table(spark, folder):
    """The state table by DDL with its properties, filled through a named relation, read back by name."""
    namespace = f"spark_catalog.q{uuid.uuid4().hex}"
    tables.create_namespace(spark, namespace)
    name = f"{namespace}.current_orders"
    kept = {k: v for k, v in tables.SILVER_PROPERTIES.items() if k.startswith("write.")}
    for _ in range(2):  # the statement may be run again
        tables.create_table(spark, name, SILVER_SCHEMA, partition_by=["event_date"], provider="parquet", properties=kept)
    with tables.named(current_state(inputs.bronze(spark, folder), FOLD_RULES, FIRST_RUN)) as relation:
        columns = ", ".join(spark.table(name).columns)
        spark.sql(f"INSERT INTO {name} SELECT {columns} FROM {relation}")
    told = {r["key"]: r["value"] for r in tables.table_properties(spark, name).collect()}
    state = tables.read_table(spark, name).select(*SILVER_SCHEMA.names)
    return plain(state.withColumn("properties_kept", F.lit(all(told.get(k) == v for k, v in kept.items()))))


@query
def parse_with_pattern(spark, folder):
    """Times in a form of their own, read by pattern."""
    events = table(spark, folder, "events").select(
        "event_id", F.date_format(F.col("ts").cast("timestamp"), "dd/MM/yyyy HH:mm:ss").alias("text")
    )
    texts = events.withColumn("text", F.when(F.col("event_id") % 5 == 0, F.lit("31/31/2024")).otherwise(F.col("text")))
    return plain(texts.select("event_id", parse_timestamp("text", "dd/MM/yyyy HH:mm:ss").alias("event_time")))


@query
def sample_with_children(spark, folder):
    """A sample of orders with its rows of two other tables, through CSV files."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    path = scratch_path(spark, "sample")
    children = {"lines": (lines, "o_orderkey", "l_orderkey"), "customers": (customers, "o_custkey", "c_custkey")}
    write_sampled_orders(orders, children, path, CHILD_CAPS, "o_orderstatus", "o_orderkey")
    parts = [
        read_csv(spark, f"{path}/{name}_sample", df.schema).groupBy(F.lit(name).alias("part")).agg(
            F.count("*").alias("rows"), F.sum(key).alias("keys")
        )
        for name, df, key in (("orders", orders, "o_orderkey"), ("lines", lines, "l_orderkey"), ("customers", customers, "c_custkey"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def profile_orders(spark, folder):
    """All parts of a table profile, as name and number."""
    times = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date"]
    found = []
    for title, df in profile_table(wide_orders(spark, folder), "order_id", "order_status", times).items():
        names = [c for c, k in df.dtypes if k == "string"]
        label = F.concat_ws(" ", F.lit(title), *names)
        numbers = [c for c in df.columns if c not in names]
        pairs = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("long").alias("value")) for c in numbers])
        found.append(df.select(label.alias("part"), F.inline(pairs)))
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole


@query
def csv_roundtrip(spark, folder):
    path = scratch_path(spark, "csv")
    orders = wide_orders(spark, folder).drop("order_cancelled_at")
    write_csv(orders, path)
    return plain(read_csv(spark, path, orders.schema))


def _log_files(spark, folder):
    """The log as files of a bounded size, so that their number grows with the log and the tasks do not;
    a stream takes them in by ``MICRO_BATCHES`` micro-batches."""
    path = scratch_path(spark, "log")
    events = table(spark, folder, "events").count()
    per_batch = max(1, math.ceil(events / (MICRO_BATCHES * EVENTS_PER_FILE)))
    inputs.log(spark, folder, MICRO_BATCHES * per_batch).select(*LOG_SCHEMA.names).write.parquet(path)
    return spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", per_batch).parquet(path)


@query
def stream_to_bronze(spark, folder):
    """The log as a stream of several micro-batches into the raw layer."""
    path = scratch_path(spark, "bronze")
    with bounded_tasks(spark):
        stream_bronze(_log_files(spark, folder), path, scratch_path(spark, "progress")).awaitTermination()
    landed = read_bronze(spark, path)
    return plain(landed.select("event_id", "order_id", "event_type", "partition", "offset", "ingestion_timestamp"))


@query
def stream_to_silver(spark, folder):
    """The state table fed by micro-batches; equal to one batch over the whole log."""
    silver = silver_table(scratch_path(spark, "silver"), STREAM_RULES)
    raw = to_bronze(_log_files(spark, folder), PROCESSED_AT)
    with bounded_tasks(spark):
        stream_silver(raw, silver, scratch_path(spark, "progress"), as_of=PROCESSED_AT).awaitTermination()
    return plain(silver.read(spark).select("order_id", "event_type", "event_time", "current_status", "event_date"))


@query
def stream_latest_state(spark, folder):
    """The same with the newest event of every order held by the stream, merged into the table at the end."""
    silver, path = silver_table(scratch_path(spark, "silver"), LATEST_RULES), scratch_path(spark, "changes")
    raw = to_bronze(_log_files(spark, folder), PROCESSED_AT)
    with bounded_tasks(spark):
        stream_latest(raw, path, scratch_path(spark, "progress"), as_of=PROCESSED_AT).awaitTermination()
    held = changed_state(spark, path).count()
    merge_changed_state(spark, path, silver)
    state = silver.read(spark).select("order_id", "event_type", "event_time", "current_status", "event_date")
    return plain(state.withColumn("orders_held", F.lit(held)))


@query
def stream_events_once(spark, folder):
    """Events without redeliveries: the log arrives week by week, each taken in by a restarted stream."""
    log, path, progress = scratch_path(spark, "log"), scratch_path(spark, "events"), scratch_path(spark, "progress")
    records = inputs.log(spark, folder).select(*LOG_SCHEMA.names)
    bounds = ["2000-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2100-01-01"]
    for first, last in zip(bounds, bounds[1:]):
        week = (F.col("timestamp") >= F.lit(first).cast("timestamp")) & (F.col("timestamp") < F.lit(last).cast("timestamp"))
        records.filter(week).write.mode("append").parquet(log)
        raw = to_bronze(spark.readStream.schema(LOG_SCHEMA).parquet(log), PROCESSED_AT)
        with bounded_tasks(spark):
            stream_events(raw, path, progress, within="1 hour").awaitTermination()
    return plain(read_bronze(spark, path).select("event_id", "order_id", "event_type"))


@query
def stream_unguarded_repeat(spark, folder):
    """Two batches under rules without a guard, the second taken in twice under a later clock."""
    rules = SilverRules(copies="fold", guarded=False)
    silver = silver_table(scratch_path(spark, "silver"), rules)
    raw = inputs.bronze(spark, folder)
    early = raw.filter(F.col("event_type").isin("ORDER_CREATED", "PAYMENT_APPROVED", "SHIPPED"))
    late = raw.filter(F.col("event_type").isin("SHIPPED", "DELIVERED", "CANCELLED"))
    for number, batch, at in ((0, early, FIRST_RUN), (1, late, SECOND_RUN), (1, late, "2024-02-03 00:00:00"), (0, early, "2024-02-03 00:00:00")):
        refresh_silver(spark, batch, silver, rules, at, batch=Batch("orders", number))
    return plain(silver.read(spark))


# -- audits, distinct counts, rejects ---------------------------------------------------------------


@query
def audit_of_layers(spark, folder):
    """Raw layer, state and summary by day, after one customer of the state was renamed behind its back."""
    silver, gold = silver_table(scratch_path(spark, "silver"), FOLD_RULES), gold_table(scratch_path(spark, "gold"))
    raw = inputs.bronze(spark, folder)
    refresh_silver(spark, raw, silver, FOLD_RULES, FIRST_RUN)
    refresh_gold(spark, silver, gold, as_of=FIRST_RUN)
    renamed = F.when(F.col("customer_id") == "7", F.lit("seven")).otherwise(F.col("customer_id"))
    state = silver.read(spark).withColumn("customer_id", renamed)
    return audit_layers(raw, state, gold.read(spark), FOLD_RULES)


@query
def fingerprints_of_days(spark, folder):
    """State tables from the two rule sets, held against each other: days on which they agree in full."""
    raw = inputs.bronze(spark, folder)
    left, right = (current_state(raw, rules, FIRST_RUN) for rules in (FOLD_RULES, OFFSET_RULES))
    return compare(state_fingerprints(left), state_fingerprints(right))


@query
def distinct_by_sketches(spark, folder):
    """Customers per week from one sketch a day, taken in by three runs that overlap; whether the
    estimate is within four standard errors of the exact count."""
    events = deliveries(spark, folder).withColumn("day", F.to_date("event_time"))
    sketches = sketch_table(scratch_path(spark, "sketches"))
    for part in ("day < '2024-01-12'", "day >= '2024-01-10' AND day < '2024-01-20'", "day >= '2024-01-10'"):
        add_to_sketches(spark, events.filter(part), "day", "customer_id", sketches)
    week = F.weekofyear("day")
    exact = events.groupBy(week.alias("period")).agg(F.count_distinct("customer_id").alias("customers"))
    estimated = distinct_by(sketches.read(spark), week)
    near = F.abs(F.col("estimate") - F.col("customers")) <= F.greatest(F.lit(1.0), 4 * standard_error() * F.col("customers"))
    return exact.join(estimated, "period").select("period", "customers", near.alias("within_error"))


@query
def rejects_retried(spark, folder):
    """The state after broken payloads were mended and taken in; events without a readable time stay out."""
    rules = LATEST_RULES
    cut, timeless = F.col("offset") % 10 == 0, F.expr("CAST(get_json_object(CAST(value AS STRING), '$.event_id') AS BIGINT) % 15 = 7")
    text = F.col("value").cast("string")
    text = F.when(timeless, F.regexp_replace(text, '"event_time":"[^"]*"', '"event_time":"unknown"')).otherwise(text)
    text = F.when(cut, F.substr(text, F.lit(1), F.char_length(text) - 1)).otherwise(text)
    raw = to_bronze(inputs.log(spark, folder).withColumn("value", text.cast("binary")), PROCESSED_AT)
    silver, rejects = silver_table(scratch_path(spark, "silver"), rules), reject_table(scratch_path(spark, "rejects"))
    refresh_silver(spark, raw, silver, rules, FIRST_RUN)
    for _ in range(2):  # the raw layer is gone over again
        keep_rejects(spark, raw, rejects, rules)
        retry_rejects(spark, rejects, lambda found: decoded_again(found, F.concat("corrupt_record", F.lit("}"))), silver, rules, FIRST_RUN)
    return plain(silver.read(spark).select("order_id", "event_id", "event_type", "event_time", "current_status", "event_date"))


@query
def checked_csv(spark, folder):
    """Orders from CSV files of two headers, with short lines and unreadable prices: sums over the good
    lines, and the number of rejects by reason."""
    path = scratch_path(spark, "csv")
    orders = table(spark, folder, "orders")
    key, price = F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string")
    bad = F.when(F.col("o_orderkey") % 53 == 1, F.lit("n/a")).otherwise(price)
    half = F.col("o_orderkey") % 2 == 0
    first = F.when(F.col("o_orderkey") % 50 == 0, key).otherwise(F.concat_ws(",", key, "o_orderstatus", bad))
    second = F.concat_ws(",", bad, F.lit("more"), key, "o_orderstatus")
    for part, line, header in ((half, first, "o_orderkey,o_orderstatus,o_totalprice"), (~half, second, "o_totalprice,note,o_orderkey,o_orderstatus")):
        orders.filter(part).select(line.alias(header)).write.mode("append").option("header", True).option("sep", "\t").csv(path)
    schema = "o_orderkey bigint, o_orderstatus string, o_totalprice double"
    good, rejects = read_checked_csv(spark, path, spark.createDataFrame([], schema).schema)
    sums = good.groupBy("o_orderstatus").agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys"))
    told = rejects.groupBy("reason").agg(F.count("*").alias("rows"), F.lit(None).cast("long").alias("keys"))
    return sums.withColumnRenamed("o_orderstatus", "part").unionByName(told.withColumnRenamed("reason", "part"))
