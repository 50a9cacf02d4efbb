"""State and summary jobs, with the known traps of such jobs."""

import datetime as dt

import pytest

from statelake.functions.clocks import parse_columns
from statelake.operators.merge import not_older, or_unset
from statelake.operators.summary import daily_summary
from statelake.plans.gold import daily_order_summary, gold_table, refresh_gold
from statelake.plans.ingest import to_bronze
from statelake.plans.silver import (
    INGESTION_RULES,
    OFFSET_RULES,
    TIME_COLUMNS,
    SilverRules,
    changed_orders,
    current_state,
    latest_events,
    latest_of_changed,
    prepare_silver,
    refresh_silver,
    rejected_records,
    silver_table,
)
from statelake.schemas import GOLD_SCHEMA, SILVER_SCHEMA
from statelake.sources.snapshots import upsert
from tests.helpers import at, event, log_rows, rows

NOW = dt.datetime(2024, 3, 2)


def raw(spark, payloads, as_of=NOW, **kw):
    return to_bronze(log_rows(spark, payloads, **kw), as_of)


def e(i, order, kind, second, ingested=None, day=1, **more):
    when = f"2024-03-{day:02d}T00:00:{second:02d}+00:00"
    return event(f"e{i}", order, kind, when, ingested and f"2024-03-{day:02d}T00:00:{ingested:02d}+00:00", **more)


BASIC = [e(1, "a", "ORDER_CREATED", 1), e(2, "a", "SHIPPED", 5, 9), e(3, "b", "ORDER_CREATED", 2)]


def test_state_has_the_declared_columns_and_types(spark):
    state = current_state(raw(spark, BASIC), as_of=NOW)
    assert [(f.name, f.dataType) for f in state.schema] == [(f.name, f.dataType) for f in SILVER_SCHEMA]


def test_two_rule_sets_differ_where_they_should(spark):
    bronze = raw(spark, BASIC)
    a = {r["order_id"]: r for r in current_state(bronze, OFFSET_RULES, NOW).collect()}["a"]
    b = {r["order_id"]: r for r in current_state(bronze, INGESTION_RULES, NOW).collect()}["a"]
    assert (a["current_status"], b["current_status"]) == ("SHIPPED", "shipped")
    assert a["ingestion_lag_sec"] == 86400 - 9 and b["ingestion_lag_sec"] == 4


def test_prepare_keeps_all_events_once(spark):
    got = prepare_silver(raw(spark, BASIC + [BASIC[1]]))
    assert rows(got, "event_id", "ingestion_lag_sec") == [("e1", 0), ("e2", 4), ("e3", 0)]


def test_times_compare_as_times_not_text(spark):
    early = event("e1", "a", "ORDER_CREATED", "2024-03-01T10:00:00+09:00")
    late = event("e2", "a", "SHIPPED", "2024-03-01T02:00:00+00:00")
    assert rows(current_state(raw(spark, [late, early]), as_of=NOW), "event_type") == [("SHIPPED",)]


def test_null_keys_never_reach_the_state(spark, tmp_path):
    table = silver_table(f"{tmp_path}/s")
    bad = ["not json", None, {**BASIC[0], "order_id": None}, {**BASIC[0], "event_time": "junk"}]
    for _ in range(2):
        refresh_silver(spark, raw(spark, BASIC + bad), table, as_of=NOW)
    assert rows(table.read(spark), "order_id") == [("a",), ("b",)]


@pytest.mark.parametrize("rules,expected", [(OFFSET_RULES, "SHIPPED"), (INGESTION_RULES, "order_created")])
def test_late_older_event(spark, tmp_path, rules, expected):
    table = silver_table(f"{tmp_path}/s", rules)
    refresh_silver(spark, raw(spark, [BASIC[1]]), table, rules, NOW)
    refresh_silver(spark, raw(spark, [BASIC[0]]), table, rules, NOW)
    assert rows(table.read(spark), "current_status") == [(expected,)]


def test_repeat_changes_only_the_stamp_or_nothing(spark, tmp_path):
    bronze = raw(spark, BASIC)
    plain = silver_table(f"{tmp_path}/plain")
    refresh_silver(spark, bronze, plain, as_of=NOW)
    first = rows(plain.read(spark).drop("updated_at"))
    refresh_silver(spark, bronze, plain, as_of=NOW + dt.timedelta(days=1))
    assert rows(plain.read(spark).drop("updated_at")) == first
    assert rows(plain.read(spark).select("updated_at").distinct()) == [(NOW + dt.timedelta(days=1),)]

    careful = SilverRules(skip_unchanged=True)
    table = silver_table(f"{tmp_path}/careful", careful)
    refresh_silver(spark, bronze, table, careful, NOW)
    assert refresh_silver(spark, bronze, table, careful, NOW + dt.timedelta(days=1)) == []
    assert rows(table.read(spark).select("updated_at").distinct()) == [(NOW,)]


def test_stored_null_time_is_stuck_unless_the_guard_allows_it(spark, tmp_path):
    stored = spark.createDataFrame([("a", *[None] * 8, dt.date(2024, 3, 1), NOW)], SILVER_SCHEMA)
    source = current_state(raw(spark, [BASIC[1]]), as_of=NOW)
    for guard, expected in [(not_older(), None), (or_unset("event_time", not_older()), "SHIPPED")]:
        table = silver_table(f"{tmp_path}/{expected}")
        table.replace(stored)
        upsert(table, source, ["order_id"], guard)
        assert rows(table.read(spark), "current_status") == [(expected,)]


def test_equal_times_across_increments(spark, tmp_path):
    """The log holds SHIPPED after CREATED at one instant; increments arrive the wrong way round."""
    pair = raw(spark, [e(1, "a", "ORDER_CREATED", 5), e(2, "a", "SHIPPED", 5)])
    created, shipped = pair.filter("event_id = 'e1'"), pair.filter("event_id = 'e2'")

    naive = silver_table(f"{tmp_path}/naive")
    for part in (shipped, created):
        refresh_silver(spark, part, naive, as_of=NOW)
    assert rows(naive.read(spark), "event_type") == [("ORDER_CREATED",)]

    ranked = silver_table(f"{tmp_path}/ranked")
    for part in (shipped, created):
        refresh_silver(spark, part, ranked, as_of=NOW, history=pair)
    assert rows(ranked.read(spark), "event_type") == [("SHIPPED",)]

    tied = SilverRules(carry_tie=True)
    carried = silver_table(f"{tmp_path}/carried", tied)
    for part in (shipped, created):
        refresh_silver(spark, part, carried, tied, NOW)
    assert rows(carried.read(spark), "event_type") == [("SHIPPED",)]


# -- daily summary -----------------------------------------------------------------------------------


def test_summary_columns_and_invariants(spark):
    state = current_state(raw(spark, BASIC), as_of=NOW)
    daily = daily_order_summary(state, NOW)
    assert [(f.name, f.dataType) for f in daily.schema] == [(f.name, f.dataType) for f in GOLD_SCHEMA]
    row = daily.first()
    assert (row["total_orders"], row["created_orders"], row["shipped_orders"], row["delivery_rate"]) == (2, 1, 1, 0.0)


def test_status_vocabulary_is_an_argument_and_the_rest_is_counted(spark):
    state = current_state(raw(spark, BASIC), INGESTION_RULES, NOW)
    row = daily_summary(state, with_other=True).first()
    assert (row["total_orders"], row["shipped_orders"], row["other_orders"]) == (2, 0, 2)
    lower = {"created_orders": "order_created", "delivered_orders": "shipped"}
    row = daily_summary(state, wanted=lower, with_other=True).first()
    assert (row["created_orders"], row["delivered_orders"], row["other_orders"], row["delivery_rate"]) == (1, 1, 0, 0.5)


@pytest.mark.parametrize("prune,only_changed,by", [(False, True, None), (True, False, None), (True, True, None), (True, True, "order_date")])
def test_emptied_day(spark, tmp_path, prune, only_changed, by):
    silver, gold = silver_table(f"{tmp_path}/s"), gold_table(f"{tmp_path}/g", by)
    refresh_silver(spark, raw(spark, [e(1, "a", "ORDER_CREATED", 1), e(2, "b", "SHIPPED", 1, day=3)]), silver, as_of=NOW)
    refresh_gold(spark, silver, gold, as_of=NOW)
    days = refresh_silver(spark, raw(spark, [e(3, "a", "DELIVERED", 1, day=2)]), silver, as_of=NOW)
    assert days == [dt.date(2024, 3, 1), dt.date(2024, 3, 2)]
    refresh_gold(spark, silver, gold, days if only_changed else None, NOW, prune_missing=prune)
    got = rows(gold.read(spark), "order_date", "total_orders", "delivered_orders")
    new = [(dt.date(2024, 3, 2), 1, 1), (dt.date(2024, 3, 3), 1, 0)]
    assert got == (new if prune else [(dt.date(2024, 3, 1), 1, 0), *new])
    if prune:
        assert sum(r[1] for r in got) == silver.read(spark).count()
    assert at("2024-03-02") == gold.read(spark).filter("order_date = '2024-03-02'").first()["updated_at"]


# -- increments and interruptions --------------------------------------------------------------------


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_a_copy_that_names_another_order_counts_in_an_increment(spark, threshold):
    """e1 of order a comes in again under b: a falls back to e2, whichever way the ids travel."""
    first = [e(1, "a", "SHIPPED", 5), e(2, "a", "ORDER_CREATED", 4)]
    later = {**e(1, "b", "SHIPPED", 5), "ingestion_time": "2024-03-09T00:00:00+00:00"}
    history = parse_columns(raw(spark, [*first, later]), TIME_COLUMNS)
    increment = history.filter("order_id = 'b' OR event_id = 'e2'")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        orders = changed_orders(history, increment)
        assert rows(orders) == [("a",), ("b",)]
        got = rows(latest_of_changed(history, orders, OFFSET_RULES), "order_id", "event_id")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == rows(latest_events(history, OFFSET_RULES), "order_id", "event_id") == [("a", "e2"), ("b", "e1")]


@pytest.mark.parametrize("rules", [OFFSET_RULES, SilverRules(skip_unchanged=True, carry_tie=True)])
def test_summary_is_right_after_a_run_died_between_the_tables(spark, tmp_path, rules):
    silver, gold = silver_table(f"{tmp_path}/s", rules), gold_table(f"{tmp_path}/g")
    refresh_silver(spark, raw(spark, [e(1, "a", "ORDER_CREATED", 1), e(2, "b", "SHIPPED", 1, day=3)]), silver, rules, NOW)
    refresh_gold(spark, silver, gold, as_of=NOW)
    late = raw(spark, [e(3, "a", "DELIVERED", 1, day=2)])
    refresh_silver(spark, late, silver, rules, NOW)  # died here
    days = refresh_silver(spark, late, silver, rules, NOW)
    assert refresh_gold(spark, silver, gold, days, NOW, prune_missing=True)
    want = rows(daily_order_summary(silver.read(spark), NOW), "order_date", "total_orders")
    assert rows(gold.read(spark), "order_date", "total_orders") == want
    assert not refresh_gold(spark, silver, gold, [], NOW) and silver.noted_changes(spark) == ([], set())


def test_rules_that_contradict_each_other_are_refused():
    with pytest.raises(ValueError):
        SilverRules(order=("event_time", "ingestion_time", "offset"), carry_tie=True)


def test_records_whose_times_the_rules_need_are_rejected(spark):
    bad = raw(spark, [{**BASIC[0], "ingestion_time": "junk"}])
    assert rows(rejected_records(bad, INGESTION_RULES), "reject_reason") == [("bad_ingestion_time",)]
    assert rejected_records(bad, OFFSET_RULES).count() == 0


def test_records_without_ids_do_not_become_one_event(spark):
    nameless = [{**BASIC[0], "event_id": None}] * 3
    assert prepare_silver(raw(spark, [*BASIC, *nameless])).count() == len(BASIC)
    assert current_state(raw(spark, [*BASIC, {**BASIC[0], "order_id": None}]), as_of=NOW).filter("order_id IS NULL").count() == 0
