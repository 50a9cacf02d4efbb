"""The summary kept up from counts of changed rows equals a recount, whatever happened in between."""

import datetime as dt
import random

import pytest

from statelake.operators.summary import apply_changes, daily_summary, summary_of_counts
from statelake.plans import gold as gold_plan
from statelake.plans.gold import COUNTED_BY, counts_table, gold_table, refresh_counts, refresh_gold_by_changes
from statelake.plans.silver import silver_table
from statelake.schemas import SILVER_SCHEMA
from statelake.sources.snapshots import SnapshotTable, upsert
from tests.helpers import rows

KINDS = ["ORDER_CREATED", "PAYMENT_APPROVED", "SHIPPED", "DELIVERED", "CANCELLED", None]
DAYS = [dt.date(2024, 1, n) for n in range(1, 5)] + [None]


def state(spark, picked):
    at = dt.datetime(2024, 1, 1)
    full = [(o, "c", f"e{o}", k, at, at, at, k, 0, d, at) for o, k, d in picked]
    return spark.createDataFrame(full, SILVER_SCHEMA)


@pytest.fixture()
def lake(tmp_path):
    return silver_table(f"{tmp_path}/silver", count_by=COUNTED_BY), counts_table(f"{tmp_path}/counts"), gold_table(f"{tmp_path}/gold")


def recounted(spark, silver):
    return rows(daily_summary(silver.read(spark)))


def test_moves_deletes_and_replays(spark, lake):
    silver, counts, gold = lake
    rng = random.Random(3)
    recounts = []
    for turn in range(7):
        picked = {f"o{rng.randrange(25)}": (rng.choice(KINDS), rng.choice(DAYS)) for _ in range(8)}
        source = state(spark, [(o, k, d) for o, (k, d) in picked.items()] + [(None, "SHIPPED", DAYS[0])])
        doomed = [DAYS[turn % 5]] if turn % 2 else None
        for _ in range(1 + turn % 2):  # every other run is repeated
            upsert(silver, source, ["order_id"], delete_missing_in=doomed, unique_source=True)
        if turn % 3 != 1:  # sometimes two runs are taken in at once
            recounts.append(refresh_counts(spark, silver, counts))
            refresh_gold_by_changes(spark, silver, counts, gold, prune_missing=True)
            assert rows(gold.read(spark).drop("updated_at")) == recounted(spark, silver)
    assert recounts == [True] + [False] * (len(recounts) - 1)  # the state was counted once only


def test_a_run_that_dies_anywhere_is_made_good(spark, lake, monkeypatch):
    silver, counts, gold = lake
    upsert(silver, state(spark, [("a", "SHIPPED", DAYS[0]), ("b", "SHIPPED", DAYS[1])]), ["order_id"])
    refresh_gold_by_changes(spark, silver, counts, gold)
    moved = state(spark, [("a", "DELIVERED", DAYS[1])])

    with monkeypatch.context() as patch:  # after the changes, before the commit
        patch.setattr(SnapshotTable, "_commit", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            upsert(silver, moved, ["order_id"])
    assert not refresh_counts(spark, silver, counts)
    upsert(silver, moved, ["order_id"])

    with monkeypatch.context() as patch:  # between the counts and the summary
        patch.setattr(gold_plan, "upsert", lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            refresh_gold_by_changes(spark, silver, counts, gold)
    refresh_gold_by_changes(spark, silver, counts, gold, prune_missing=True)
    assert rows(gold.read(spark).drop("updated_at")) == recounted(spark, silver)
    before = gold.version(spark)
    assert not refresh_gold_by_changes(spark, silver, counts, gold, prune_missing=True) and gold.version(spark) == before


def test_changes_of_a_dead_commit_are_not_taken_for_another_ones(spark, lake, monkeypatch):
    silver, counts, _ = lake
    upsert(silver, state(spark, [("a", "SHIPPED", DAYS[0])]), ["order_id"])
    refresh_counts(spark, silver, counts)
    with monkeypatch.context() as patch:
        patch.setattr(SnapshotTable, "_commit", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            upsert(silver, state(spark, [("b", "SHIPPED", DAYS[0])]), ["order_id"])
    silver.replace(state(spark, [("c", "DELIVERED", DAYS[2])]))  # writes no changes
    assert refresh_counts(spark, silver, counts)  # so the state is counted
    assert rows(counts.read(spark), *COUNTED_BY, "orders") == [(DAYS[2], "DELIVERED", 1)]


def test_the_state_is_not_read(spark, lake, monkeypatch):
    silver, counts, gold = lake
    upsert(silver, state(spark, [("a", "SHIPPED", DAYS[0])]), ["order_id"])
    refresh_gold_by_changes(spark, silver, counts, gold)
    upsert(silver, state(spark, [("a", "DELIVERED", DAYS[1])]), ["order_id"])
    read = SnapshotTable.read
    monkeypatch.setattr(SnapshotTable, "read", lambda self, *a, **k: pytest.fail("read") if self.root == silver.root else read(self, *a, **k))
    refresh_gold_by_changes(spark, silver, counts, gold, prune_missing=True)
    assert rows(gold.read(spark), "order_date", "delivered_orders") == [(DAYS[1], 1)]


def test_a_days_old_row_stays_unless_pruned(spark, lake):
    silver, counts, gold = lake
    upsert(silver, state(spark, [("a", "SHIPPED", DAYS[0])]), ["order_id"])
    refresh_gold_by_changes(spark, silver, counts, gold)
    upsert(silver, state(spark, [("a", "SHIPPED", DAYS[1])]), ["order_id"])
    refresh_gold_by_changes(spark, silver, counts, gold)
    assert rows(gold.read(spark), "order_date") == [(DAYS[0],), (DAYS[1],)]
    refresh_gold_by_changes(spark, silver, counts, gold, prune_missing=True)
    assert rows(gold.read(spark), "order_date") == [(DAYS[1],)]


def test_counts_below_zero_are_an_error(spark):
    counts = spark.createDataFrame([(DAYS[0], "SHIPPED", 1)], "d date, s string, orders long")
    with pytest.raises(Exception, match="more rows away"):
        apply_changes(counts, spark.createDataFrame([(DAYS[0], "SHIPPED", -2)], "d date, s string, change long"), ["d", "s"]).collect()


def test_summary_of_counts_equals_the_summary_of_rows(spark):
    held = state(spark, [(f"o{i}", KINDS[i % 6], DAYS[i * i % 5]) for i in range(40)])
    counts = held.groupBy(*COUNTED_BY).count().withColumnRenamed("count", "orders")
    assert rows(summary_of_counts(counts, with_other=True)) == rows(daily_summary(held, with_other=True))


def test_the_state_table_has_to_count_its_changes(spark, lake, tmp_path):
    with pytest.raises(ValueError):
        refresh_gold_by_changes(spark, silver_table(f"{tmp_path}/plain"), lake[1], lake[2])
