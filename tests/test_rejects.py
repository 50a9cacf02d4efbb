import datetime as dt

import pytest
from pyspark.sql import functions as F

from statelake.plans import rejects as module
from statelake.plans.ingest import to_bronze
from statelake.plans.rejects import GIVEN_UP, MENDED, OPEN, decoded_again, keep_rejects, reject_table, retry_rejects
from statelake.plans.silver import SilverRules, current_state, refresh_silver, silver_table
from tests.helpers import event, log_rows, rows

NOW = dt.datetime(2024, 3, 2)
RULES = SilverRules(copies="fold", carry_tie=True, guarded=False)  # a batch taken in twice would show
GOOD = [event(f"e{i}", f"o{i}", "SHIPPED", f"2024-03-01T00:00:0{i}+00:00") for i in range(3)]


def broken(spark):
    import json

    cut = json.dumps(event("e7", "o1", "DELIVERED", "2024-03-01T01:00:00+00:00"))[:-1]
    late = event("e8", "o2", "DELIVERED", "sometime")
    return to_bronze(log_rows(spark, [*GOOD, cut, late, "no hope"]), NOW)


def close(found):
    return decoded_again(found, F.concat(module.CORRUPT_COLUMN, F.lit("}")))


def name_time(found):
    return found.withColumn("event_time", F.when(F.col("event_time") == "sometime", "2024-03-01T02:00:00+00:00").otherwise(F.col("event_time")))


@pytest.fixture()
def lake(spark, tmp_path):
    table, silver = reject_table(f"{tmp_path}/rejects"), silver_table(f"{tmp_path}/silver", RULES)
    refresh_silver(spark, broken(spark), silver, RULES, NOW)
    keep_rejects(spark, broken(spark), table, RULES)
    return table, silver


def states(spark, table):
    return {(r["reject_reason"], r["event_id"]): (r["state"], r["tries"]) for r in table.read(spark).collect()}


def test_rejects_are_kept_once(spark, lake):
    table, _ = lake
    keep_rejects(spark, broken(spark), table, RULES)
    assert states(spark, table) == {("bad_json", None): (OPEN, 0), ("bad_event_time", "e8"): (OPEN, 0)} and table.read(spark).count() == 3


def test_mended_records_reach_the_state_and_hopeless_ones_are_given_up(spark, lake):
    table, silver = lake
    assert retry_rejects(spark, table, close, silver, RULES, NOW, most_tries=2) == [dt.date(2024, 3, 1)]
    assert states(spark, table) == {(None, "e7"): (MENDED, 1), ("bad_event_time", "e8"): (OPEN, 1), ("bad_json", None): (OPEN, 1)}
    assert retry_rejects(spark, table, name_time, silver, RULES, NOW, most_tries=2)
    assert states(spark, table) == {(None, "e7"): (MENDED, 1), (None, "e8"): (MENDED, 2), ("bad_json", None): (GIVEN_UP, 2)}
    whole = [*GOOD, event("e7", "o1", "DELIVERED", "2024-03-01T01:00:00+00:00"), event("e8", "o2", "DELIVERED", "2024-03-01T02:00:00+00:00")]
    wanted = current_state(to_bronze(log_rows(spark, whole), NOW), RULES, NOW)
    columns = ["order_id", "event_id", "event_type", "event_time", "current_status"]
    assert rows(silver.read(spark), *columns) == rows(wanted, *columns)
    assert retry_rejects(spark, table, close, silver, RULES, NOW) == []  # none is open
    keep_rejects(spark, broken(spark), table, RULES)  # the raw layer is gone over again
    assert {s for s, _ in states(spark, table).values()} == {MENDED, GIVEN_UP}


def test_a_retry_that_dies_before_its_outcome_is_stored_enters_once(spark, lake, monkeypatch):
    table, silver = lake
    with monkeypatch.context() as patch:
        patch.setattr(module, "upsert", lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            retry_rejects(spark, table, close, silver, RULES, NOW)
    first, version = rows(silver.read(spark)), silver.version(spark)
    assert {o[0] for o in first} == {"o0", "o1", "o2"} and all(s == (OPEN, 0) for s in states(spark, table).values())
    other = dt.datetime(2024, 3, 9)  # would show in the stamps
    retry_rejects(spark, table, lambda found: pytest.fail("mended twice"), silver, RULES, other)
    assert rows(silver.read(spark)) == first and silver.version(spark) == version
    assert states(spark, table)[(None, "e7")] == (MENDED, 1)


def test_rows_that_a_mend_leaves_out_count_a_try(spark, lake):
    table, silver = lake
    retry_rejects(spark, table, lambda found: found.filter("1 = 0"), silver, RULES, NOW, most_tries=1)
    assert {s for s in states(spark, table).values()} == {(GIVEN_UP, 1)}


def test_nothing_was_rejected(spark, tmp_path):
    table, silver = reject_table(f"{tmp_path}/rejects"), silver_table(f"{tmp_path}/silver", RULES)
    keep_rejects(spark, to_bronze(log_rows(spark, GOOD), NOW), table, RULES)
    assert retry_rejects(spark, table, close, silver, RULES, NOW) == []
