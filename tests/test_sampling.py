import hashlib

import pytest
from pyspark.sql import functions as F

from statelake.operators.sampling import ORDER_STATUS_CAPS, child_rows, stratified_sample
from statelake.plans.sample import stratified_orders, write_sample
from tests.helpers import rows


def brute(records, caps, seed=42):
    chosen = []
    for stratum, cap in caps.items():
        of = [r for r in records if r[1] == stratum]
        of.sort(key=lambda r: hashlib.md5(f"{r[0]}-{seed}".encode()).hexdigest())
        chosen += of[:cap]
    return sorted(chosen, key=str)


RECORDS = [(f"k{i}", "big" if i % 10 else "small") for i in range(3000)]
SCHEMA = "id string, kind string"


@pytest.mark.parametrize("caps", [{"big": 700, "small": 5}, {"big": 1}, {"big": 2700, "small": 9999}, {"small": 0, "big": 3}, {"none": 4}])
@pytest.mark.parametrize("digits", [1, 3])
def test_equals_brute_force(spark, caps, digits):
    df = spark.createDataFrame(RECORDS, SCHEMA).repartition(5)
    got = stratified_sample(df, "kind", caps, "id", digits=digits)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(RECORDS, caps)


def test_seed_changes_the_draw(spark):
    df = spark.createDataFrame(RECORDS, SCHEMA)
    assert rows(stratified_sample(df, "kind", {"big": 50}, "id", seed=1)) == [
        (k, s) for k, s in brute(RECORDS, {"big": 50}, seed=1)
    ]


def test_many_copies_of_one_key_still_give_the_exact_size(spark):
    """One key holds most of the rows; whatever its hash, the size is exact."""
    copies = spark.range(0, 2000, 1, 6).select(F.lit("same").alias("id"), F.lit("big").alias("kind"))
    df = spark.createDataFrame(RECORDS, SCHEMA).union(copies)
    for cap in (10, 1500, 2500, 4600):
        assert stratified_sample(df, "kind", {"big": cap}, "id").count() == cap


def test_fixed_caps_add_up():
    assert sum(ORDER_STATUS_CAPS.values()) == 9997


def test_children_of_a_sample(spark, tmp_path):
    orders = spark.createDataFrame([(f"o{i}", "delivered" if i % 2 else "created") for i in range(40)], "order_id string, order_status string")
    items = orders.select("order_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("n"))
    sample = stratified_orders(orders, {"items": items}, {"delivered": 7, "created": 5})
    assert sample["orders"].count() == 12 and sample["items"].count() == 24
    write_sample(sample, str(tmp_path))
    back = spark.read.option("header", True).csv(f"{tmp_path}/items_sample")
    assert back.count() == 24 and back.columns == ["order_id", "n"]


def test_children_by_shuffle_and_by_broadcast_agree(spark):
    keys = spark.createDataFrame([("a",), ("a",), ("c",)], "k string")
    children = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "child string, v int")
    for bound in (None, 2, 10**9):
        assert rows(child_rows(children, keys, "k", "child", bound)) == [("a", 1), ("a", 2)]
