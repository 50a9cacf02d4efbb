"""Merge semantics, against a plain-Python model and by hand-written cases."""

import datetime as dt
import random

import pytest

from statelake.operators.merge import (
    and_changed,
    changed_rows,
    merge_rows,
    not_older,
    not_older_then,
    or_unset,
    replace_rows,
)
from tests.helpers import rows

SCHEMA = "k string, v long, w long"


def model(target, source, accepts, delete_missing=False, updated=("v", "w")):
    """Row-by-row MERGE on column 0; NULL keys never match."""
    result, used = [], set()
    by_key = {s[0]: s for s in source if s[0] is not None}
    names = {"v": 1, "w": 2}
    for t in target:
        s = by_key.get(t[0]) if t[0] is not None else None
        if s is None:
            if not delete_missing:
                result.append(t)
            continue
        used.add(s[0])
        if accepts(t, s):
            row = list(t)
            for c in updated:
                row[names[c]] = s[names[c]]
            result.append(tuple(row))
        else:
            result.append(t)
    result += [s for s in source if s[0] is None or s[0] not in used]
    return sorted(result, key=lambda r: tuple((v is None, str(v)) for v in r))


def random_side(rng, n, span, nulls):
    keys = rng.sample(range(span), n)
    out = [(f"k{k}", rng.choice([None, *range(6)]), rng.randrange(100)) for k in keys]
    return out + [(None, rng.randrange(6), rng.randrange(100)) for _ in range(nulls)]


def ge(t, s):
    return t[1] is not None and s[1] is not None and s[1] >= t[1]


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("guard,accepts", [(None, lambda t, s: True), (not_older("v"), ge)])
@pytest.mark.parametrize("updated", [("v", "w"), ("w",)])
def test_random_merges_equal_the_model(spark, seed, guard, accepts, updated):
    rng = random.Random(seed)
    target, source = random_side(rng, 40, 80, 3), random_side(rng, 40, 80, 2)
    t, s = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA)
    expected = model(target, source, accepts, updated=updated)
    assert rows(merge_rows(t, s, ["k"], guard, updated)) == expected
    changed = changed_rows(t, s, ["k"], guard, updated)
    assert rows(replace_rows(t, changed, ["k"])) == expected


def test_delete_missing(spark):
    target, source = [("a", 1, 1), ("b", 1, 1), (None, 1, 1)], [("a", 2, 2), ("c", 3, 3)]
    t, s = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA)
    assert rows(merge_rows(t, s, ["k"], delete_missing=True)) == [("a", 2, 2), ("c", 3, 3)]


def test_guard_false_or_null_keeps_the_target_and_equal_updates(spark):
    t = spark.createDataFrame([("a", 5, 0), ("b", 5, 0), ("c", None, 0)], SCHEMA)
    s = spark.createDataFrame([("a", 4, 9), ("b", 5, 9), ("c", 7, 9)], SCHEMA)
    assert rows(merge_rows(t, s, ["k"], not_older("v"))) == [("a", 5, 0), ("b", 5, 9), ("c", None, 0)]
    opened = merge_rows(t, s, ["k"], or_unset("v", not_older("v")))
    assert ("c", 7, 9) in rows(opened)


def test_tie_column_decides_equal_values(spark):
    t = spark.createDataFrame([("a", 5, 10), ("b", 5, 10)], SCHEMA)
    s = spark.createDataFrame([("a", 5, 9), ("b", 5, 11)], SCHEMA)
    assert rows(merge_rows(t, s, ["k"], not_older_then("v", "w"))) == [("a", 5, 10), ("b", 5, 11)]


def test_unchanged_identity_is_skipped(spark):
    t = spark.createDataFrame([("a", 5, 10)], SCHEMA)
    s = spark.createDataFrame([("a", 5, 10)], SCHEMA)
    assert changed_rows(t, s, ["k"], and_changed(["w"], not_older("v"))).isEmpty()
    assert not changed_rows(t, s, ["k"], not_older("v")).isEmpty()


def test_two_source_rows_for_a_key_raise(spark):
    t = spark.createDataFrame([("a", 1, 1)], SCHEMA)
    s = spark.createDataFrame([("a", 2, 2), ("a", 3, 3)], SCHEMA)
    for df in (merge_rows(t, s, ["k"]), changed_rows(t, s, ["k"])):
        with pytest.raises(Exception, match="more than one source row"):
            df.collect()


def test_two_null_keys_are_no_duplicate(spark):
    t = spark.createDataFrame([(None, 1, 1)], SCHEMA)
    s = spark.createDataFrame([(None, 2, 2), (None, 3, 3)], SCHEMA)
    assert len(rows(merge_rows(t, s, ["k"]))) == 3


def test_missing_source_columns_insert_null_and_keep_stored_values(spark):
    t = spark.createDataFrame([("a", 1, 1)], SCHEMA)
    s = spark.createDataFrame([("a", 2), ("b", 3)], "k string, v long")
    assert rows(merge_rows(t, s, ["k"])) == [("a", 2, 1), ("b", 3, None)]


def test_composite_key(spark):
    day = dt.date(2024, 1, 1)
    t = spark.createDataFrame([("a", day, 1), ("a", None, 1)], "k string, d date, v int")
    s = spark.createDataFrame([("a", day, 2), ("a", None, 2)], "k string, d date, v int")
    assert rows(merge_rows(t, s, ["k", "d"])) == [("a", day, 2), ("a", None, 1), ("a", None, 2)]


def test_null_keys_do_not_gather_in_one_task(spark):
    """Half of the target has a NULL key; the join must not send those rows to a single reducer."""
    from pyspark.sql import functions as F

    t = spark.range(0, 4000, 1, 4).select(
        F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("k"), F.col("id").alias("v"), F.lit(0).alias("w")
    )
    s = spark.createDataFrame([("2", 1, 1)], SCHEMA)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        merged = merge_rows(t, s, ["k"]).filter("k is null").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in merged) == 2000
    assert max(r["count"] for r in merged) < 2000


def test_changed_rows_shuffles_each_side_once_and_null_keys_pass_by(spark, capsys):
    target, source = spark.range(10).selectExpr("id AS k", "id AS v"), spark.range(5).selectExpr("if(id = 3, null, id) AS k", "id AS v")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        changed_rows(target, source, ["k"], unique_source=True).explain()
        text = capsys.readouterr().out
        assert text.count("Exchange hashpartitioning") == 2 and "Union" in text and text.count("Join") == 1
        replace_rows(target, source, ["k"]).explain()
        text = capsys.readouterr().out
        assert text.count("Exchange hashpartitioning") == 2 and "LeftAnti" in text and text.count("Join") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    found = sorted(tuple(r) for r in changed_rows(target, source, ["k"], unique_source=True).select("v", "__updated").collect())
    assert found == [(0, True), (1, True), (2, True), (3, False), (4, True)]
