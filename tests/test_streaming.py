import datetime as dt
import json
import os

import pytest

from statelake.operators.latest import latest_by
from statelake.plans.ingest import to_bronze
from statelake.plans.silver import SilverRules, current_state, refresh_silver, silver_table
from statelake.schemas import LOG_SCHEMA
from statelake.sources.files import read_bronze
from statelake.sources.snapshots import Batch, SnapshotTable
from statelake.streaming import latest
from statelake.streaming.bronze import stream_bronze
from statelake.streaming.copies import dropped, late_copies, stream_events
from statelake.streaming.latest import LATEST_RULES, changed_state, merge_changed_state, newest, stream_latest
from statelake.streaming.silver import STREAM_RULES, stream_id, stream_silver
from tests.helpers import event, log_rows, rows

NOW = dt.datetime(2024, 3, 2)
KINDS = ["ORDER_CREATED", "PAYMENT_APPROVED", "SHIPPED", "DELIVERED"]


def shuffled_log(spark):
    """Four events for each of six orders, out of order, some redelivered, some sharing a time, some broken."""
    payloads = []
    for order in range(6):
        for step in (2, 0, 3, 1):
            when = f"2024-03-01T00:00:{(step // 2) * 10 + order:02d}+00:00"
            payloads.append(event(f"{order}-{step}", f"o{order}", KINDS[step], when))
    payloads += payloads[3:9] + ["not json", None]
    return log_rows(spark, payloads)


@pytest.fixture()
def files(spark, tmp_path):
    path = f"{tmp_path}/log"
    shuffled_log(spark).repartitionByRange(3, "offset").write.parquet(path)
    return path


def stream(spark, path):
    return spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def test_raw_stream_equals_the_batch_and_resumes(spark, files, tmp_path):
    out, progress = f"{tmp_path}/bronze", f"{tmp_path}/progress"
    for _ in range(2):  # the second run finds nothing new
        stream_bronze(stream(spark, files), out, progress).awaitTermination()
    kept = ["event_id", "order_id", "partition", "offset", "corrupt_record"]
    assert rows(read_bronze(spark, out), *kept) == rows(to_bronze(shuffled_log(spark), NOW), *kept)
    log_rows(spark, [event("new", "o9", "SHIPPED", "2024-03-01T01:00:00+00:00")]).write.mode("append").parquet(files)
    stream_bronze(stream(spark, files), out, progress).awaitTermination()
    assert read_bronze(spark, out).count() == shuffled_log(spark).count() + 1


@pytest.mark.parametrize("rules", [STREAM_RULES, SilverRules(carry_tie=True, copies="fold")], ids=["skip", "fold"])
def test_state_from_micro_batches_equals_one_batch(spark, files, tmp_path, rules):
    table = silver_table(f"{tmp_path}/silver", rules)
    raw = to_bronze(stream(spark, files), NOW)
    stream_silver(raw, table, f"{tmp_path}/progress", rules, NOW).awaitTermination()
    batch = to_bronze(shuffled_log(spark), NOW).filter("order_id is not null")
    assert rows(table.read(spark)) == rows(current_state(batch, rules, NOW))


def test_a_repeated_micro_batch_changes_nothing(spark, files, tmp_path):
    table = silver_table(f"{tmp_path}/silver", STREAM_RULES)
    for attempt in range(2):  # a lost checkpoint replays the whole log
        raw = to_bronze(stream(spark, files), NOW)
        stream_silver(raw, table, f"{tmp_path}/progress{attempt}", as_of=NOW).awaitTermination()
        if attempt == 0:
            first, versions = rows(table.read(spark)), table.manifest(spark)
    assert rows(table.read(spark)) == first and table.manifest(spark) == versions


# -- batches that are repeated --------------------------------------------------------------------

UNGUARDED = SilverRules(guarded=False, carry_tie=True)


def forget_last_batch(checkpoint):
    """As if the driver had died after the batch wrote its data and before the checkpoint noted it."""
    done = sorted((n for n in os.listdir(f"{checkpoint}/commits") if n.isdigit()), key=int)
    for name in (done[-1], f".{done[-1]}.crc"):
        os.remove(f"{checkpoint}/commits/{name}")


def test_a_batch_repeated_after_a_crash_changes_nothing_even_unguarded(spark, files, tmp_path):
    table, progress = silver_table(f"{tmp_path}/silver", UNGUARDED), f"{tmp_path}/progress"
    stream_silver(to_bronze(stream(spark, files), NOW), table, progress, UNGUARDED, NOW).awaitTermination()
    first, version = rows(table.read(spark)), table.version(spark)
    assert set(table.batches(spark)) == {stream_id(spark, progress)}
    for _ in range(2):
        forget_last_batch(progress)
        later = dt.datetime(2024, 3, 3)  # another clock would show in every row
        stream_silver(to_bronze(stream(spark, files), NOW), table, progress, UNGUARDED, later).awaitTermination()
        assert rows(table.read(spark)) == first and table.version(spark) == version


def test_without_batch_numbers_the_repeat_would_show(spark, files, tmp_path):
    table = silver_table(f"{tmp_path}/silver", UNGUARDED)
    batch = to_bronze(shuffled_log(spark), NOW)
    refresh_silver(spark, batch, table, UNGUARDED, NOW, batch=Batch("s", 4))
    version = table.version(spark)
    assert refresh_silver(spark, batch, table, UNGUARDED, NOW, batch=Batch("s", 4)) == []
    assert refresh_silver(spark, batch, table, UNGUARDED, NOW, batch=Batch("s", 3)) == []
    assert table.version(spark) == version
    assert refresh_silver(spark, batch, table, UNGUARDED, NOW, batch=Batch("other", 0))  # another stream
    assert refresh_silver(spark, batch, table, UNGUARDED, NOW)  # no stream
    assert table.version(spark) == version + 2 and table.batches(spark) == {"s": 4, "other": 0}


def test_a_table_from_before_batches_were_named(spark, tmp_path):
    table = silver_table(f"{tmp_path}/silver", UNGUARDED)
    refresh_silver(spark, to_bronze(shuffled_log(spark), NOW), table, UNGUARDED, NOW)
    path = f"{table.root}/manifest/0000000001.json"
    with open(path) as file:
        partitions = json.load(file)["partitions"]
    for name in (path, f"{table.root}/manifest/.0000000001.json.crc"):
        if os.path.exists(name):
            os.remove(name)
    with open(path, "w") as file:
        json.dump(partitions, file)
    assert table.read(spark).count() == 6 and table.batches(spark) == {}


# -- state in the state store ---------------------------------------------------------------------

FOLD = SilverRules(carry_tie=True, copies="fold")


def test_state_kept_by_the_stream_equals_the_batch_and_resumes(spark, files, tmp_path):
    out, progress = f"{tmp_path}/changes", f"{tmp_path}/progress"
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    for _ in range(2):
        stream_latest(to_bronze(stream(spark, files), NOW), out, progress, LATEST_RULES, NOW, width=3).awaitTermination()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    batch = to_bronze(shuffled_log(spark), NOW).filter("order_id is not null")
    assert rows(changed_state(spark, out)) == rows(current_state(batch, FOLD, NOW))
    old = event("0-old", "o0", "ORDER_CREATED", "2024-02-01T00:00:00+00:00")  # older than what the store knows
    new = event("1-new", "o1", "CANCELLED", "2024-03-05T00:00:00+00:00")
    log_rows(spark, [old, new]).write.mode("append").parquet(files)
    stream_latest(to_bronze(stream(spark, files), NOW), out, progress, LATEST_RULES, NOW).awaitTermination()
    state = {r["order_id"]: r["event_type"] for r in changed_state(spark, out).collect()}
    assert state["o0"] == "DELIVERED" and state["o1"] == "CANCELLED" and len(state) == 6


def test_no_micro_batch_reads_the_state_table(spark, files, tmp_path, monkeypatch):
    monkeypatch.setattr(SnapshotTable, "read", lambda *a, **k: pytest.fail("read"))
    stream_latest(to_bronze(stream(spark, files), NOW), f"{tmp_path}/changes", f"{tmp_path}/progress", as_of=NOW).awaitTermination()


def test_changes_merge_into_the_table_once(spark, files, tmp_path, monkeypatch):
    out, table = f"{tmp_path}/changes", silver_table(f"{tmp_path}/silver", LATEST_RULES)
    assert merge_changed_state(spark, out, table) == []
    stream_latest(to_bronze(stream(spark, files), NOW), out, f"{tmp_path}/progress", as_of=NOW).awaitTermination()
    with monkeypatch.context() as patch:  # dies after the commit
        patch.setattr(latest, "delete", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            merge_changed_state(spark, out, table)
    version = table.version(spark)
    merge_changed_state(spark, out, table)
    assert table.version(spark) == version and changed_state(spark, out).count() == 0
    batch = to_bronze(shuffled_log(spark), NOW).filter("order_id is not null")
    assert rows(table.read(spark)) == rows(current_state(batch, FOLD, NOW))


def test_rules_that_a_stream_cannot_keep(spark, files, tmp_path):
    with pytest.raises(ValueError):
        stream_latest(to_bronze(stream(spark, files), NOW), f"{tmp_path}/c", f"{tmp_path}/p", STREAM_RULES)
    with pytest.raises(ValueError):
        merge_changed_state(spark, f"{tmp_path}/c", silver_table(f"{tmp_path}/t", UNGUARDED), UNGUARDED)


def test_newest_equals_the_ranking(spark):
    made = [(k, a, b, f"{k}{a}{b}") for k in "xyz" for a in (None, 1, 2) for b in (None, 3, 4)]
    frame = spark.createDataFrame(made, "k string, a int, b int, v string")
    assert rows(newest(frame, ["k"], ["a", "b"])) == rows(latest_by(frame, ["k"], ["a", "b"]))


# -- copies within a bound ------------------------------------------------------------------------


def delivered(spark, path, records):
    """One file, and so one micro-batch, of (event id, minute)."""
    made = [("k".encode(), json.dumps(event(e, f"o{e}", "SHIPPED", "2024-03-01T00:00:00+00:00")).encode(), "t", 0, m, dt.datetime(2024, 3, 1, m // 60, m % 60)) for e, m in records]
    spark.createDataFrame([(bytearray(k), bytearray(v), *rest) for k, v, *rest in made], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_copies_within_the_bound_vanish_and_later_ones_are_counted(spark, tmp_path):
    path, out, progress = f"{tmp_path}/log", f"{tmp_path}/events", f"{tmp_path}/progress"
    found = []
    slices = [
        [("a", 0), ("b", 1), ("a", 2)],  # a copy in the same batch
        [("b", 20), ("c", 30), (None, 31)],  # one in the next batch
        [("d", 200)],  # moves the bound far past a, b and c
        [("a", 210), ("d", 215)],  # a came too long ago to be known, d is
        [("c", 40)],  # older than the bound itself
    ]
    for records in slices:
        delivered(spark, path, records)
        query = stream_events(to_bronze(spark.readStream.schema(LOG_SCHEMA).parquet(path), NOW), out, progress, "1 hour")
        query.awaitTermination()
        found.append(dropped(query))
    landed = rows(read_bronze(spark, out), "event_id")
    assert landed == [("a",), ("a",), ("b",), ("c",), ("d",)]
    assert rows(late_copies(spark, out)) == [("a", 1)]
    assert sum(f.copies for f in found) == 3 and [f.too_late for f in found] == [0, 0, 0, 0, 1]


def test_a_restarted_stream_writes_no_batch_twice(spark, tmp_path):
    path, out, progress = f"{tmp_path}/log", f"{tmp_path}/events", f"{tmp_path}/progress"
    delivered(spark, path, [("a", 0), ("b", 1)])
    for _ in range(2):
        stream_events(to_bronze(spark.readStream.schema(LOG_SCHEMA).parquet(path), NOW), out, progress).awaitTermination()
        forget_last_batch(progress)
    assert rows(read_bronze(spark, out), "event_id") == [("a",), ("b",)]
