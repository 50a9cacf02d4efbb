import datetime as dt
import random

import pytest
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from statelake.operators.merge import and_changed, merge_rows, not_older
from statelake.sources import snapshots
from statelake.sources.snapshots import SnapshotTable, upsert
from tests.helpers import rows

SCHEMA = StructType(
    [StructField("k", StringType()), StructField("v", LongType()), StructField("d", DateType())]
)


def day(n):
    return None if n is None else dt.date(2024, 1, 1) + dt.timedelta(days=n)


def frame(spark, records):
    return spark.createDataFrame([(k, v, day(d)) for k, v, d in records], SCHEMA)


@pytest.fixture()
def table(tmp_path):
    return SnapshotTable(f"{tmp_path}/t", SCHEMA, "d")


def test_empty_table_reads_as_empty(spark, table):
    assert table.read(spark).schema == SCHEMA and table.read(spark).count() == 0


def test_replace_and_read(spark, table):
    table.replace(frame(spark, [("a", 1, 0)]))
    table.replace(frame(spark, [("b", 2, 1), ("c", 3, None)]))
    assert rows(table.read(spark)) == [("b", 2, day(1)), ("c", 3, None)]
    assert rows(table.read(spark, partitions=[None])) == [("c", 3, None)]
    assert rows(table.read(spark, partitions=[day(1)])) == [("b", 2, day(1))]


def test_only_touched_partitions_are_written_and_emptied_ones_go(spark, table):
    table.replace(frame(spark, [("a", 1, 0), ("b", 1, 1), ("c", 1, 2)]))
    before = table.manifest(spark)
    written = table.replace_partitions(frame(spark, [("a", 2, 1), ("b", 1, 1)]), [day(0), day(1)])
    after = table.manifest(spark)
    assert written == [str(day(1))]
    assert set(after) == {str(day(1)), str(day(2))}
    assert after[str(day(2))] == before[str(day(2))] and after[str(day(1))] != before[str(day(1))]
    assert rows(table.read(spark)) == [("a", 2, day(1)), ("b", 1, day(1)), ("c", 1, day(2))]


def test_files_without_a_manifest_are_invisible(spark, table):
    table.replace(frame(spark, [("a", 1, 0)]))
    frame(spark, [("x", 9, 0)]).write.partitionBy("d").parquet(f"{table.root}/data/commit=cdead")
    with open(f"{table.root}/manifest/_0000000002.json.draft", "w") as draft:
        draft.write("half a manif")
    assert rows(table.read(spark)) == [("a", 1, day(0))]
    table.replace(frame(spark, [("b", 2, 0)]))
    assert rows(table.read(spark)) == [("b", 2, day(0))]


def test_a_second_writer_fails_when_it_publishes(spark, table, monkeypatch):
    table.replace(frame(spark, [("a", 1, 0)]))
    monkeypatch.setattr(SnapshotTable, "_commits", lambda self, spark: [])
    with pytest.raises(FileExistsError):
        table.replace(frame(spark, [("b", 2, 0)]))
    monkeypatch.undo()
    assert rows(table.read(spark)) == [("a", 1, day(0))]


def test_partition_column_must_have_plain_values(tmp_path):
    with pytest.raises(ValueError):
        SnapshotTable(str(tmp_path), SCHEMA, "k")


@pytest.mark.parametrize("seed", range(1))
@pytest.mark.parametrize("partition_by", ["d", None])
@pytest.mark.parametrize("guard", [None, not_older("v"), and_changed(["d"], not_older("v"))])
def test_upserts_equal_merge_rows(spark, tmp_path, seed, partition_by, guard):
    rng = random.Random(seed)
    table = SnapshotTable(f"{tmp_path}/t", SCHEMA, partition_by)
    model = frame(spark, [])
    for _ in range(3):
        keys = rng.sample(range(20), 8)
        batch = [(f"k{k}", rng.randrange(9), rng.choice([None, 0, 1, 2, 3])) for k in keys]
        batch.append((None, 1, 1))
        source = frame(spark, batch)
        merged = rows(merge_rows(model, source, ["k"], guard))
        upsert(table, source, ["k"], guard)
        assert rows(table.read(spark)) == merged
        model = spark.createDataFrame(merged, SCHEMA)


def test_rows_move_between_partitions_without_a_trace(spark, table):
    upsert(table, frame(spark, [("a", 1, 0), ("b", 1, 0)]), ["k"])
    assert upsert(table, frame(spark, [("a", 2, 5), ("b", 2, 6)]), ["k"]) == [day(0), day(5), day(6)]
    assert rows(table.read(spark)) == [("a", 2, day(5)), ("b", 2, day(6))]
    assert str(day(0)) not in table.manifest(spark)


def test_a_run_that_changes_nothing_writes_nothing(spark, table):
    source = frame(spark, [("a", 1, 0), ("b", 1, 1)])
    guard = and_changed(["v", "d"], not_older("v"))
    upsert(table, source, ["k"], guard)
    before = table.manifest(spark)
    assert upsert(table, source, ["k"], guard) == []
    assert table.manifest(spark) == before


def test_untouched_partitions_stay_in_place(spark, table):
    upsert(table, frame(spark, [(f"k{i}", 1, i) for i in range(5)]), ["k"])
    before = table.manifest(spark)
    assert upsert(table, frame(spark, [("k2", 9, 2)]), ["k"]) == [day(2)]
    after = table.manifest(spark)
    assert [d for d in after if after[d] != before[d]] == [str(day(2))]


def test_duplicate_source_key_is_an_error_and_leaves_the_table_alone(spark, table):
    with pytest.raises(Exception, match="more than one source row"):
        upsert(table, frame(spark, [("a", 2, 0), ("a", 3, 0)]), ["k"])
    assert not table.exists(spark)
    upsert(table, frame(spark, [("a", 1, 0)]), ["k"])
    with pytest.raises(Exception, match="more than one source row"):
        upsert(table, frame(spark, [("a", 2, 0), ("a", 3, 0)]), ["k"])
    assert rows(table.read(spark)) == [("a", 1, day(0))]


def test_delete_missing_in_named_partitions_only(spark, table):
    upsert(table, frame(spark, [("a", 1, 0), ("b", 1, 0), ("c", 1, 1), ("d", 1, None)]), ["k"])
    upsert(table, frame(spark, [("a", 2, 0)]), ["k"], delete_missing_in=[day(0), None])
    assert rows(table.read(spark)) == [("a", 2, day(0)), ("c", 1, day(1))]


def test_delete_missing_without_partitions(spark, tmp_path):
    table = SnapshotTable(f"{tmp_path}/t", SCHEMA)
    upsert(table, frame(spark, [("a", 1, 0), ("b", 1, 0), ("c", 1, 1), ("d", 1, None)]), ["k"])
    upsert(table, frame(spark, [("a", 2, 0)]), ["k"], delete_missing_in=[day(0), None], delete_column="d")
    assert rows(table.read(spark)) == [("a", 2, day(0)), ("c", 1, day(1))]
    by_day = SnapshotTable(f"{tmp_path}/u", SCHEMA, "d")
    with pytest.raises(ValueError):
        upsert(by_day, frame(spark, []), ["k"], delete_missing_in=["a"], delete_column="k")


def test_notes_stay_until_they_are_dropped(spark, table):
    upsert(table, frame(spark, [("a", 1, 0)]), ["k"], note_changes=True)
    names, noted = table.noted_changes(spark)
    assert len(names) == 1 and noted is None  # the first commit may touch anything
    table.drop_notes(spark, names)
    upsert(table, frame(spark, [("a", 2, 3), ("b", 2, None)]), ["k"], note_changes=True)
    names, noted = table.noted_changes(spark)
    assert noted == {day(0), day(3), None}
    table.drop_notes(spark, names)
    assert table.noted_changes(spark) == ([], set())


def test_the_size_of_the_source_does_not_change_the_result(spark, tmp_path, monkeypatch):
    results = []
    for limit in (0, 1 << 40):
        monkeypatch.setattr(snapshots, "FEW_BYTES", limit)
        table = SnapshotTable(f"{tmp_path}/{limit}", SCHEMA, "d")
        upsert(table, frame(spark, [("a", 1, 0), ("b", 1, 1), (None, 1, 1)]), ["k"])
        upsert(table, frame(spark, [("a", 2, 5), ("c", 2, None), (None, 2, 2)]), ["k"])
        results.append(rows(table.read(spark)))
    assert results[0] == results[1] and len(results[0]) == 5
