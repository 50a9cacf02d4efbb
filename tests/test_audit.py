import datetime as dt

import pytest
from pyspark.sql import functions as F

from statelake.operators.fingerprint import add_up, compare, fingerprints
from statelake.operators.sketches import day_sketches, distinct_by, distinct_in, standard_error, unite
from statelake.plans.audit import add_to_sketches, audit_layers, sketch_table
from statelake.plans.gold import gold_table, refresh_gold
from statelake.plans.ingest import to_bronze
from statelake.plans.silver import refresh_silver, silver_table
from tests.helpers import event, log_rows, rows

NOW = dt.datetime(2024, 3, 9)
KINDS = ["ORDER_CREATED", "PAYMENT_APPROVED", "SHIPPED", "DELIVERED"]
SCHEMA = "d date, a string, b string, n long"
DAY = dt.date(2024, 3, 1)


def small(spark):
    made = [(DAY, "x", None, 1), (DAY, None, "x", 1), (DAY, "x", None, 1), (None, "", None, None), (dt.date(2024, 3, 2), "y", "z", 2)]
    return spark.createDataFrame(made, SCHEMA)


def prints(df):
    return rows(fingerprints(df, "d", ["a", "b", "n"]))


def test_order_and_partitions_do_not_matter_and_parts_add_up(spark):
    frame = small(spark)
    assert prints(frame) == prints(frame.orderBy("n", "a").repartition(5)) == prints(frame.coalesce(1))
    first, rest = frame.filter("n = 1"), frame.filter("n is null or n <> 1")
    parts = [fingerprints(p, "d", ["a", "b", "n"]) for p in (first, rest, frame.filter("1 = 0"))]
    assert rows(add_up(*parts)) == prints(frame)


@pytest.mark.parametrize(
    "change",
    [
        lambda f: f.withColumn("b", F.when(F.col("b") == "z", "Z").otherwise(F.col("b"))),
        lambda f: f.unionByName(f.filter("a = 'y'")),  # a copy more
        lambda f: f.select("d", F.col("b").alias("a"), F.col("a").alias("b"), "n").filter("n = 2").unionByName(f.filter("n is null or n <> 2")),
        lambda f: f.withColumn("a", F.when(F.col("a") == "y", F.lit(None)).otherwise(F.col("a"))),
    ],
    ids=["value", "copy", "columns", "null"],
)
def test_any_change_shows_on_its_day_only(spark, change):
    columns = ["a", "b", "n"]
    found = compare(fingerprints(small(spark), "d", columns), fingerprints(change(small(spark)), "d", columns))
    assert rows(found.filter("not same"), "day") == [(dt.date(2024, 3, 2),)]


def test_days_of_one_side_only(spark):
    some = fingerprints(small(spark).filter("d is not null"), "d", ["a"])
    found = compare(some, fingerprints(small(spark), "d", ["a"]))
    assert rows(found.filter("not same"), "day", "left_rows", "right_rows") == [(None, 0, 1)]


@pytest.fixture()
def lake(spark, tmp_path):
    payloads = [event(f"{o}-{s}", f"o{o}", KINDS[s], f"2024-03-0{1 + (o + s) % 4}T00:00:0{s}+00:00") for o in range(12) for s in range(o % 4 + 1)]
    bronze = to_bronze(log_rows(spark, payloads + ["broken", None] + payloads[:5]), NOW)
    silver, gold = silver_table(f"{tmp_path}/silver"), gold_table(f"{tmp_path}/gold")
    refresh_silver(spark, bronze, silver, as_of=NOW)
    refresh_gold(spark, silver, gold, as_of=NOW)
    return bronze, silver, gold


def test_sound_layers_agree_on_every_day(spark, lake):
    bronze, silver, gold = lake
    found = audit_layers(bronze, silver.read(spark), gold.read(spark))
    assert found.count() == silver.read(spark).select("event_date").distinct().count() > 1
    assert found.filter("not (same_state and same_summary) or raw_orders <> state_orders").count() == 0


def test_one_altered_row_is_named_by_its_day(spark, lake):
    bronze, silver, gold = lake
    altered = silver.read(spark).withColumn("customer_id", F.when(F.col("order_id") == "o5", "other").otherwise(F.col("customer_id")))
    day = silver.read(spark).filter("order_id = 'o5'").first()["event_date"]
    assert rows(audit_layers(bronze, altered, gold.read(spark)).filter("not same_state"), "day", "same_summary") == [(day, True)]


def test_lost_and_moved_rows_and_old_summaries(spark, lake):
    bronze, silver, gold = lake
    one = silver.read(spark).filter("order_id = 'o5'").first()
    lost = silver.read(spark).filter("order_id <> 'o5'")
    found = audit_layers(bronze, lost, gold.read(spark)).filter("not same_state").collect()
    assert [(r["day"], r["raw_orders"] - r["state_orders"], r["same_summary"]) for r in found] == [(one["event_date"], 1, False)]
    moved = lost.unionByName(silver.read(spark).filter("order_id = 'o5'").withColumn("event_date", F.lit(dt.date(2025, 1, 1))))
    days = audit_layers(bronze, moved, gold.read(spark)).filter("not same_state")
    assert rows(days, "day") == [(one["event_date"],), (dt.date(2025, 1, 1),)]


def test_sketches_of_any_range_are_within_the_error(spark, tmp_path):
    days = F.date_add(F.lit(DAY), (F.col("id") % 10).cast("int"))
    events = spark.range(60_000).select(days.alias("d"), (F.col("id") * 7919 % 20_000).alias("user"))
    table = sketch_table(f"{tmp_path}/sketches")
    for part in (events.filter("user % 3 = 0"), events.filter("user % 3 > 0"), events.filter("user % 5 = 0")):  # the last came before
        add_to_sketches(spark, part, "d", "user", table)
    stored = table.read(spark)
    assert stored.count() == 10
    for first, last in ((0, 0), (0, 9), (3, 6), (9, 9)):
        low, high = DAY + dt.timedelta(days=first), DAY + dt.timedelta(days=last)
        exact = events.filter(F.col("d").between(low, high)).select("user").distinct().count()
        assert abs(distinct_in(stored, low, high).first()[0] - exact) <= 4 * standard_error() * exact
    assert distinct_in(stored, dt.date(2030, 1, 1), dt.date(2030, 1, 2)).first()[0] == 0
    months = {r["period"]: r["estimate"] for r in distinct_by(stored, F.month("day")).collect()}
    assert abs(months[3] - 20_000) <= 4 * standard_error() * 20_000


def test_sketches_do_not_depend_on_the_way_they_arrived(spark):
    events = spark.range(5000).select(F.lit(DAY).alias("d"), F.when(F.col("id") % 7 > 0, F.col("id") % 900).alias("k"))
    whole = day_sketches(events, "d", "k")
    parts = unite(day_sketches(events.filter("id < 100"), "d", "k"), day_sketches(events, "d", "k"))
    assert distinct_in(whole, DAY, DAY).first() == distinct_in(parts, DAY, DAY).first()
