"""Run a job from the command line: ``python -m statelake <job> --help``, or through ``spark-submit``."""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from statelake.operators.envelope import encode, stamp_event
from statelake.operators.lifecycle import lifecycle_events
from statelake.operators.profile import reconcile, row_count, top_rows, value_counts
from statelake.plans.gold import gold_table, merge_gold_table, refresh_gold
from statelake.plans.ingest import ingest_bronze, ingest_kafka, offset_table
from statelake.plans.profile import profile_table
from statelake.plans.sample import write_sampled_orders
from statelake.plans.silver import (
    INGESTION_RULES,
    OFFSET_RULES,
    SilverRules,
    merge_silver_table,
    prepare_silver,
    refresh_silver,
    rejected_records,
    silver_table,
)
from statelake.schemas import GOLD_SCHEMA, LOG_SCHEMA, ORDERS_CSV_SCHEMA, SILVER_SCHEMA
from statelake.session import build_session, fit_session
from statelake.sources import tables
from statelake.sources.files import landed_from, read_bronze, read_csv, read_parquet
from statelake.sources.kafka import write_log

RULES = {"offset": OFFSET_RULES, "ingestion": INGESTION_RULES}


def chosen_rules(args: argparse.Namespace) -> SilverRules:
    """The named rules with the options of the command line on top."""
    return replace(
        RULES[args.rules],
        **({"copies": "fold"} if args.fold else {}),
        **({"skip_unchanged": True} if args.skip_unchanged else {}),
        **({"carry_tie": True} if args.carry_tie else {}),
    )


ORDER_TIMES = [name for name in ORDERS_CSV_SCHEMA.names if name.endswith(("_at", "_timestamp", "_date"))]


def profile(spark: SparkSession, args: argparse.Namespace) -> None:
    orders = read_csv(spark, args.orders, ORDERS_CSV_SCHEMA)
    for title, df in profile_table(orders, "order_id", "order_status", ORDER_TIMES).items():
        print(title)
        df.show(truncate=False)


def sample(spark: SparkSession, args: argparse.Namespace) -> None:
    # child tables pass through as text; only their order id is looked at
    children = {
        name: (spark.read.option("header", True).csv(path), "order_id", "order_id")
        for name, path in (("items", args.items), ("payments", args.payments))
        if path
    }
    write_sampled_orders(read_csv(spark, args.orders, ORDERS_CSV_SCHEMA), children, args.out)


def events(spark: SparkSession, args: argparse.Namespace) -> None:
    found = lifecycle_events(read_csv(spark, args.orders, ORDERS_CSV_SCHEMA), order="partition")
    records = encode(stamp_event(found))
    if args.servers:
        write_log(records, args.servers, args.topic)
    else:
        records.write.parquet(args.out)


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.servers:
        run = ingest_kafka(spark, args.servers, args.topic, args.raw, args.offsets)
    else:
        run = ingest_bronze(spark, read_parquet(spark, args.log, LOG_SCHEMA), args.raw, args.offsets)
    print("written" if run.written else "nothing new")
    offset_table(args.offsets).read(spark).orderBy("topic", "partition").show(truncate=False)


def prepare(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = read_bronze(spark, args.raw)
    reconcile(raw, "event_id").show()
    value_counts(rejected_records(raw), "reject_reason").show(truncate=False)
    top_rows(prepare_silver(raw), [F.desc("event_time"), F.desc("offset")], 20).show(truncate=False)


def silver(spark: SparkSession, args: argparse.Namespace) -> None:
    since = landed_from(args.since_date, args.since_hour) if args.since_date else None
    raw = read_bronze(spark, args.raw, since)
    history = read_bronze(spark, args.raw) if since is not None else None
    rules = chosen_rules(args)
    if args.catalog_table:
        merge_silver_table(raw, args.catalog_table, rules, history=history)
        state = tables.read_table(spark, args.catalog_table)
    else:
        table = silver_table(args.table, rules)
        days = refresh_silver(spark, raw, table, rules, history=history)
        print("changed days:", *days)
        state = table.read(spark)
    row_count(state, "silver_rows").show()
    value_counts(state, "current_status", "order_count").show(truncate=False)
    top_rows(state, [F.desc("event_time"), F.asc("order_id")], 20).show(truncate=False)


def gold(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.catalog_table:
        merge_gold_table(spark, args.silver, args.catalog_table, prune_missing=args.prune_missing)
        summary = tables.read_table(spark, args.catalog_table)
    else:
        table = gold_table(args.table)
        # only what refreshes of the state noted since the last run, unless all of it is asked for
        days = [] if args.changed_only else None
        refresh_gold(spark, silver_table(args.silver), table, days, prune_missing=args.prune_missing)
        summary = table.read(spark)
    summary.orderBy("order_date").show(100, truncate=False)


def create_tables(spark: SparkSession, args: argparse.Namespace) -> None:
    for layer, name, schema, by, properties in (
        ("silver", "orders", SILVER_SCHEMA, "event_date", tables.SILVER_PROPERTIES),
        ("gold", "daily_order_summary", GOLD_SCHEMA, "order_date", tables.GOLD_PROPERTIES),
    ):
        namespace = f"{args.catalog}.{layer}"
        tables.create_namespace(spark, namespace)
        tables.create_table(
            spark, f"{namespace}.{name}", schema, partition_by=[by], provider=args.provider, properties=properties
        )
        tables.list_tables(spark, namespace).show(truncate=False)
        tables.table_properties(spark, f"{namespace}.{name}").show(100, truncate=False)
        tables.table_columns(spark, f"{namespace}.{name}").show(100, truncate=False)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="statelake")
    top.add_argument("--master", help="Spark master; leave out under spark-submit")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(run, *required: str, optional: tuple[str, ...] = ()) -> argparse.ArgumentParser:
        sub = jobs.add_parser(run.__name__.replace("_", "-"))
        sub.set_defaults(run=run)
        for name in required:
            sub.add_argument(f"--{name}", required=True)
        for name in optional:
            sub.add_argument(f"--{name}")
        return sub

    job(profile, "orders")
    job(sample, "orders", "out", optional=("items", "payments"))
    def one_of(sub: argparse.ArgumentParser, *names: str) -> argparse.ArgumentParser:
        group = sub.add_mutually_exclusive_group(required=True)
        for name in names:
            group.add_argument(f"--{name}")
        return sub

    one_of(job(events, "orders"), "out", "servers").add_argument("--topic", default="order-events")
    one_of(job(ingest, "raw", "offsets"), "log", "servers").add_argument("--topic", default="order-events")
    job(prepare, "raw")
    state = one_of(job(silver, "raw", optional=("since-date",)), "table", "catalog-table")
    for flag in ("fold", "skip-unchanged", "carry-tie"):
        state.add_argument(f"--{flag}", action="store_true")
    state.add_argument("--since-hour", type=int, default=0)
    state.add_argument("--rules", choices=sorted(RULES), default="offset")
    summary = one_of(job(gold, "silver"), "table", "catalog-table")
    for flag in ("prune-missing", "changed-only"):
        summary.add_argument(f"--{flag}", action="store_true")
    made = job(create_tables)
    made.add_argument("--catalog", default="local")
    made.add_argument("--provider", default="iceberg")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"statelake-{args.job}", args.master)
    inputs = (vars(args).get(name) for name in ("orders", "items", "payments", "log", "raw", "silver", "table"))
    fit_session(spark, *[path for path in inputs if path and "/" in path])
    args.run(spark, args)


if __name__ == "__main__":
    main()
