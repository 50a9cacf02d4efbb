import pytest

from statelake.operators.merge import not_older
from statelake.plans.upkeep import maintain_provider_table
from statelake.schemas import GOLD_SCHEMA, ORDERS_CSV_SCHEMA, SILVER_SCHEMA
from statelake.session import (
    MAX_SHUFFLE_PARTITIONS,
    build_session,
    catalog_conf,
    engine_conf,
    fit_session,
    materialized,
    shared_folder,
    shuffle_partitions_for,
    split_bytes_for,
)
from statelake.sources import kafka, tables
from statelake.sources.files import read_csv, read_parquet, write_csv
from statelake.sources.paths import exists
from tests.helpers import at, rows

COLUMNS = SILVER_SCHEMA.names


def test_ddl_text():
    ddl = tables.table_ddl("local.silver.orders", SILVER_SCHEMA, ["event_date"], properties=tables.SILVER_PROPERTIES)
    assert ddl.startswith("CREATE TABLE IF NOT EXISTS local.silver.orders (`order_id` STRING, ")
    assert "`ingestion_lag_sec` BIGINT" in ddl and "USING iceberg" in ddl
    assert "PARTITIONED BY (`event_date`)" in ddl and "'write.merge.mode' = 'merge-on-read'" in ddl
    gold = tables.table_ddl("g", GOLD_SCHEMA, ["order_date"], properties=tables.GOLD_PROPERTIES)
    assert "`delivery_rate` DOUBLE" in gold and "merge-on-read" not in gold


def test_create_twice_and_look_at_it(spark):
    tables.create_namespace(spark, "silver")
    tables.create_namespace(spark, "silver")
    for _ in range(2):
        tables.create_table(
            spark, "silver.orders", SILVER_SCHEMA, partition_by=["event_date"], provider="parquet",
            properties=tables.SILVER_PROPERTIES,
        )
    assert "orders" in [r["tableName"] for r in tables.list_tables(spark, "silver").collect()]
    props = dict(rows(tables.table_properties(spark, "silver.orders")))
    assert props["write.target-file-size-bytes"] == "134217728" and props["format-version"] == "2"
    described = tables.table_columns(spark, "silver.orders").orderBy("position").collect()
    # this provider lists partition columns last
    expected = [(f.name, f.dataType.simpleString()) for f in SILVER_SCHEMA if f.name != "event_date"] + [("event_date", "date")]
    assert [(r["column"], r["type"]) for r in described] == expected
    assert tables.read_table(spark, "silver.orders").count() == 0


def test_merge_text_is_what_spark_parses(spark):
    text = tables.merge_sql("local.silver.orders", "updates", ["order_id"], COLUMNS, not_older("event_time"), delete_missing=True)
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text).toString()
    assert "Merge" in plan and "(s.event_time >= 't.event_time)" in plan.replace("'s.", "s.")
    assert "order_id = s.order_id," not in text.split("UPDATE SET")[1].split("\n")[0]
    assert "WHEN NOT MATCHED BY SOURCE THEN DELETE" in text
    plain = tables.merge_sql("t1", "v", ["a", "b"], ["a", "b", "c"])
    assert "ON t.a = s.a AND t.b = s.b" in plain and "WHEN MATCHED THEN UPDATE SET t.c = s.c" in plain


def test_merge_needs_a_provider(spark):
    tables.create_namespace(spark, "silver")
    tables.create_table(spark, "silver.plain", GOLD_SCHEMA, provider="parquet")
    with pytest.raises(Exception, match="MERGE"):
        tables.merge_into("silver.plain", spark.createDataFrame([], GOLD_SCHEMA), ["order_date"])
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("statelake_")]


def test_maintenance_statements_parse_and_need_a_catalog(spark):
    for text in tables.maintenance_sql("local", "silver.orders", "2024-01-01 00:00:00"):
        spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    with pytest.raises(RuntimeError):
        maintain_provider_table(spark, "nowhere", "silver.orders", "2024-01-01 00:00:00")


def test_catalog_settings():
    conf = catalog_conf("lake", "s3://bucket/w")
    assert conf["spark.sql.catalog.lake.type"] == "hadoop" and conf["spark.sql.catalog.lake.warehouse"] == "s3://bucket/w"
    assert len(conf) == 4


def test_kafka_connector_is_asked_for_by_name_only(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka.read_slice(spark, "nowhere:9092", "t")


def test_csv_round_trip(spark, tmp_path):
    orders = spark.createDataFrame(
        [("o1", "c1", "created", at("2024-01-01T10:00:00"), None, None, None, None), ("o2", None, "x,y \"z\"", None, None, None, None, None)],
        ORDERS_CSV_SCHEMA,
    )
    write_csv(orders, f"{tmp_path}/csv")
    assert rows(read_csv(spark, f"{tmp_path}/csv", ORDERS_CSV_SCHEMA)) == rows(orders)


def test_partition_columns_of_a_subtree_need_the_base_path(spark, tmp_path):
    base = f"{tmp_path}/p"
    spark.range(4).selectExpr("id", "id % 2 AS part").write.partitionBy("part").parquet(base)
    assert read_parquet(spark, f"{base}/part=1").columns == ["id"]
    assert read_parquet(spark, f"{base}/part=1", base_path=base).columns == ["id", "part"]


def test_session_helpers(spark, tmp_path):
    assert build_session("again") is not None
    assert shuffle_partitions_for(0) == 8
    assert shuffle_partitions_for(10 * 1024**3) == 240
    assert shuffle_partitions_for(100 * 1024**4) == MAX_SHUFFLE_PARTITIONS
    assert engine_conf(1024**4)["spark.sql.shuffle.partitions"] == str(3 * 8192)
    assert engine_conf(100 * 1024**4)["spark.sql.files.maxPartitionBytes"] == str(split_bytes_for(100 * 1024**4))
    assert split_bytes_for(0) == 128 * 1024**2 < split_bytes_for(100 * 1024**4) < 1024**3
    before = spark.conf.get("spark.sql.shuffle.partitions")
    fit_session(spark, str(tmp_path))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_materialized_rows_are_fixed_and_cleaned_up(spark):
    assert "shared" in shared_folder(spark)
    with materialized(spark.range(5).selectExpr("id", "uuid() AS u")) as fixed:
        assert rows(fixed) == rows(fixed)
        path = fixed.inputFiles()[0].rsplit("/", 1)[0]
        assert exists(spark, path)
    assert not exists(spark, path)
