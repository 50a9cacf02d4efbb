"""The jobs from the command line, from order files to the daily summary."""

import pytest
from pyspark.sql import functions as F

from statelake.__main__ import main
from statelake.plans.gold import gold_table
from statelake.plans.silver import silver_table
from statelake.schemas import LOG_SCHEMA, ORDERS_CSV_SCHEMA
from statelake.sources.files import write_csv
from tests.helpers import at, rows


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    orders = [
        (f"o{i}", f"c{i}", "delivered" if i % 2 else "shipped", at("2024-01-01"), at("2024-01-02"), at("2024-01-03"),
         at("2024-01-04") if i % 2 else None, None)
        for i in range(10)
    ]
    write_csv(spark.createDataFrame(orders, ORDERS_CSV_SCHEMA), f"{base}/orders")
    write_csv(spark.createDataFrame([(f"o{i}", i) for i in range(20)], "order_id string, n int"), f"{base}/items")
    return base


def test_profile_and_sample(spark, lake, capsys):
    main(["profile", "--orders", f"{lake}/orders"])
    assert "delivered" in capsys.readouterr().out
    main(["sample", "--orders", f"{lake}/orders", "--items", f"{lake}/items", "--out", f"{lake}/sample"])
    assert spark.read.option("header", True).csv(f"{lake}/sample/items_sample").count() == 10
    assert spark.read.option("header", True).csv(f"{lake}/sample/orders_sample").count() == 10


def test_from_orders_to_summary(spark, lake, capsys):
    main(["events", "--orders", f"{lake}/orders", "--out", f"{lake}/records"])
    log = spark.read.parquet(f"{lake}/records").select(
        "key", "value", F.lit("order-events").alias("topic"), F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"), F.current_timestamp().alias("timestamp"),
    )
    assert log.count() == 35
    log.select(*LOG_SCHEMA.names).write.parquet(f"{lake}/log")

    ingest = ["ingest", "--log", f"{lake}/log", "--raw", f"{lake}/raw", "--offsets", f"{lake}/offsets"]
    main(ingest)
    assert "written" in capsys.readouterr().out
    main(ingest)
    assert "nothing new" in capsys.readouterr().out
    main(["prepare", "--raw", f"{lake}/raw"])
    assert "rows_before" in capsys.readouterr().out

    main(["silver", "--raw", f"{lake}/raw", "--table", f"{lake}/silver"])
    main(["silver", "--raw", f"{lake}/raw", "--table", f"{lake}/silver", "--since-date", "2020-01-01"])
    state = silver_table(f"{lake}/silver").read(spark)
    assert state.count() == 10 and "changed days" in capsys.readouterr().out

    main(["gold", "--silver", f"{lake}/silver", "--table", f"{lake}/gold", "--prune-missing"])
    assert rows(gold_table(f"{lake}/gold").read(spark).agg(F.sum("total_orders"))) == [(10,)]
    assert "delivery_rate" in capsys.readouterr().out


def test_tables_and_catalog_merges(spark, lake, capsys):
    main(["create-tables", "--catalog", "spark_catalog", "--provider", "parquet"])
    assert "daily_order_summary" in capsys.readouterr().out
    # the job gets as far as the provider, which here has no row-level writes
    for job in (
        ["silver", "--raw", f"{lake}/raw", "--catalog-table", "silver.orders"],
        ["gold", "--silver", "silver.orders", "--catalog-table", "gold.daily_order_summary"],
    ):
        with pytest.raises(Exception, match="MERGE"):
            main(job)
