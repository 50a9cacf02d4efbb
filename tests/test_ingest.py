import datetime as dt

import pytest

from statelake.plans import ingest as ingest_module
from statelake.plans.ingest import ingest_bronze, offset_table
from statelake.sources.files import landed_from, read_bronze
from tests.helpers import event, log_rows, rows

RUN1, RUN2, RUN3 = (dt.datetime(2024, 3, 1, h) for h in (1, 2, 3))


def payloads(n, first=0):
    return [event(f"e{i}", f"o{i % 3}", "SHIPPED", f"2024-03-01T00:00:{i:02d}+00:00") for i in range(first, n)]


@pytest.fixture()
def places(tmp_path):
    return f"{tmp_path}/bronze", f"{tmp_path}/offsets"


def test_second_run_takes_only_what_is_new(spark, places):
    bronze, offsets = places
    assert ingest_bronze(spark, log_rows(spark, payloads(6)), bronze, offsets, RUN1).written
    assert ingest_bronze(spark, log_rows(spark, payloads(10)), bronze, offsets, RUN2).written
    raw = read_bronze(spark, bronze)
    assert rows(raw, "event_id") == sorted((f"e{i}",) for i in range(10))
    assert raw.filter(landed_from("2024-03-01", 2)).count() == 4
    assert rows(raw.select("raw_hour").distinct()) == [(1,), (2,)]
    expected = rows(log_rows(spark, payloads(10)).groupBy("topic", "partition").agg({"offset": "max"}))
    assert rows(offset_table(offsets).read(spark)) == [(t, p, o + 1) for t, p, o in expected]


def test_nothing_new_writes_nothing(spark, places):
    bronze, offsets = places
    log = log_rows(spark, payloads(4))
    ingest_bronze(spark, log, bronze, offsets, RUN1)
    versions = offset_table(offsets).manifest(spark)
    result = ingest_bronze(spark, log, bronze, offsets, RUN2)
    assert not result.written and offset_table(offsets).manifest(spark) == versions
    assert read_bronze(spark, bronze).count() == 4


def test_silent_partition_is_carried_forward(spark, places):
    bronze, offsets = places
    log = log_rows(spark, payloads(9))
    ingest_bronze(spark, log, bronze, offsets, RUN1)
    before = rows(offset_table(offsets).read(spark))
    assert len(before) == 2
    more = log_rows(spark, payloads(12)).filter("partition = 0")
    ingest_bronze(spark, more, bronze, offsets, RUN2)
    after = dict((r[1], r[2]) for r in rows(offset_table(offsets).read(spark)))
    assert after[1] == dict((r[1], r[2]) for r in before)[1] and after[0] > before[0][2]


def test_crash_before_positions_repeats_but_loses_nothing(spark, places, monkeypatch):
    bronze, offsets = places
    log = log_rows(spark, payloads(5))

    def crash(*_):
        raise RuntimeError("crash")

    monkeypatch.setattr(ingest_module, "next_offsets", crash)
    with pytest.raises(RuntimeError):
        ingest_bronze(spark, log, bronze, offsets, RUN1)
    monkeypatch.undo()
    ingest_bronze(spark, log, bronze, offsets, RUN2)
    raw = read_bronze(spark, bronze)
    assert raw.count() == 10 and raw.select("event_id").distinct().count() == 5


def test_positions_come_from_what_was_written(spark, places):
    """A slice that is already cut to the stored positions is taken as it is."""
    bronze, offsets = places
    ingest_bronze(spark, log_rows(spark, payloads(5)), bronze, offsets, RUN1, resumed=True)
    seen = read_bronze(spark, bronze).groupBy("topic", "partition").agg({"offset": "max"})
    assert rows(offset_table(offsets).read(spark)) == [(t, p, o + 1) for t, p, o in rows(seen)]


def test_default_clock_and_zoned_clock(spark, places):
    bronze, offsets = places
    ingest_bronze(spark, log_rows(spark, payloads(2)), bronze, offsets)
    zoned = dt.datetime(2024, 3, 1, 23, 30, tzinfo=dt.timezone(dt.timedelta(hours=-2)))
    ingest_bronze(spark, log_rows(spark, payloads(4)), bronze, offsets, zoned)
    assert read_bronze(spark, bronze).filter("raw_date = '2024-03-02' and raw_hour = 1").count() == 2
    assert rows(offset_table(offsets).read(spark), "next_offset") != []


def test_broken_records_land_too(spark, places):
    bronze, offsets = places
    ingest_bronze(spark, log_rows(spark, ["not json", None, *payloads(1)]), bronze, offsets, RUN3)
    assert read_bronze(spark, bronze).count() == 3
    assert rows(read_bronze(spark, bronze).filter("corrupt_record is not null"), "corrupt_record") == [("not json",)]


def test_kafka_slice_starts_at_the_stored_positions(spark, places, monkeypatch):
    """The connector itself is not available here, so its read is stood in for."""
    from statelake.sources.kafka import starting_offsets

    bronze, offsets = places
    asked = []

    def slice_of(spark, servers, topic, positions, options):
        asked.append(starting_offsets(positions, topic))
        return log_rows(spark, payloads(4))

    monkeypatch.setattr(ingest_module, "read_slice", slice_of)
    ingest_module.ingest_kafka(spark, "host:9092", "order-events", bronze, offsets, RUN1)
    ingest_module.ingest_kafka(spark, "host:9092", "order-events", bronze, offsets, RUN2)
    assert asked[0] == "earliest" and asked[1].startswith('{"order-events": {"0": ')
