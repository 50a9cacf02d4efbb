import random

import pytest
from pyspark.sql import functions as F

from statelake.operators.latest import dedup_newest, drop_copies, latest_by, rows_of_changed_keys
from statelake.plans.silver import INGESTION_RULES, OFFSET_RULES, SilverRules, latest_events
from tests.helpers import rows

SCHEMA = "event_id string, order_id string, event_time int, ingestion_time int, offset long"


def brute_latest(records, rules):
    """Dedup then latest, in plain Python, with NULLs last in descending order."""
    names = ["event_id", "order_id", "event_time", "ingestion_time", "offset"]

    def rank(record, order):
        return tuple((record[names.index(c)] is not None, record[names.index(c)] or 0) for c in order)

    kept = {}
    for r in records:
        if r[0] not in kept or rank(r, rules.copy_order) > rank(kept[r[0]], rules.copy_order):
            kept[r[0]] = r
    best = {}
    for r in kept.values():
        order = [c for c in rules.order]
        key = tuple((r[names.index(c)] is not None, r[names.index(c)] if r[names.index(c)] is not None else 0) for c in order)
        if r[1] not in best or key > best[r[1]][0]:
            best[r[1]] = (key, r)
    return sorted((r for _, r in best.values()), key=str)


def random_log(rng, n):
    records, offset = [], 0
    for i in range(n):
        order, when = f"o{rng.randrange(12)}", rng.choice([None, *range(5)])
        ingested = rng.randrange(10)
        for _ in range(rng.randrange(1, 4)):
            records.append((f"e{i:03d}", order, when, ingested, offset))
            offset += 1
            ingested += rng.randrange(3)
    return records


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("rules", [OFFSET_RULES, INGESTION_RULES], ids=["offset", "ingestion"])
def test_latest_events_equal_brute_force(spark, seed, rules):
    log = random_log(random.Random(seed), 60)
    df = spark.createDataFrame(log, SCHEMA).repartition(3)
    expected = brute_latest(log, rules)
    assert sorted((tuple(r) for r in latest_events(df, rules).collect()), key=str) == expected
    # folding is the same state, copies agreeing on order and event time and coming in in offset order
    folded = SilverRules(copies="fold", order=rules.order)
    assert sorted((tuple(r) for r in latest_events(df, folded).collect()), key=str) == expected


def test_newest_copy_survives_and_null_loses(spark):
    df = spark.createDataFrame(
        [("e", "o", 1, 5, 0), ("e", "o", 1, 9, 1), ("e", "o", 1, None, 2), ("f", "o", 1, None, 3)], SCHEMA
    )
    assert rows(dedup_newest(df), "event_id", "ingestion_time") == [("e", 9), ("f", None)]


def test_drop_copies_keeps_one_per_key(spark):
    df = spark.createDataFrame([("e", "o", 1, 5, 0), ("e", "o", 1, 9, 1), ("f", "o", 1, 1, 3)], SCHEMA)
    assert rows(drop_copies(df), "event_id") == [("e",), ("f",)]


def test_equal_event_time_is_decided_by_the_rule(spark):
    df = spark.createDataFrame([("a", "o", 1, 9, 1), ("b", "o", 1, 3, 2)], SCHEMA)
    assert rows(latest_events(df, OFFSET_RULES), "event_id") == [("b",)]
    assert rows(latest_events(df, INGESTION_RULES), "event_id") == [("a",)]


def test_unknown_copy_rule(spark):
    with pytest.raises(ValueError):
        latest_events(spark.createDataFrame([], SCHEMA), SilverRules(copies="whatever"))


def test_order_takes_columns(spark):
    df = spark.createDataFrame([("a", "o", 1, 1, 1), ("b", "o", 2, 1, 1)], SCHEMA)
    assert rows(latest_by(df, ["order_id"], [F.col("event_time").asc()]), "event_id") == [("a",)]


def test_history_of_changed_keys(spark):
    history = spark.createDataFrame([("a", "o1", 1, 1, 1), ("b", "o1", 2, 1, 1), ("c", "o2", 2, 1, 1)], SCHEMA)
    increment = history.filter("event_id = 'b'")
    assert rows(rows_of_changed_keys(history, increment, ["order_id"]), "event_id") == [("a",), ("b",)]


def test_group_limit_runs_before_and_after_the_exchange(spark, capsys):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    latest_by(df, ["k"], ["id"]).explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") == 2
    before = plan[plan.index("Exchange"):]
    assert "Partial" in before
