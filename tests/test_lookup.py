"""Tables with a key: files are sorted by it and carry Bloom filters, upserts of few keys skip row groups."""

import hashlib
import random

import pyarrow.parquet as pq
import pytest

from statelake.operators.merge import merge_rows, not_older
from statelake.sources import snapshots
from statelake.sources.snapshots import SnapshotTable, few_values, looked_up, upsert
from tests.helpers import rows
from tests.test_snapshots import SCHEMA, frame

DAYS, PER_DAY = 6, 4000
PUSHED = "spark.sql.parquet.pushdown.inFilterThreshold"


def name(i):
    return hashlib.md5(str(i).encode()).hexdigest()


@pytest.fixture(scope="module")
def big(spark, tmp_path_factory):
    """Every day holds keys from the whole range, so ranges alone rule no file out."""
    table = SnapshotTable(f"{tmp_path_factory.mktemp('big')}/t", SCHEMA, "d", key="k", row_group_bytes=32 * 1024)
    table.replace(frame(spark, [(name(i), 1, i % DAYS) for i in range(DAYS * PER_DAY)] + [(None, 1, 0)]))
    return table


def files(table, spark):
    return [f.removeprefix("file://").removeprefix("file:") for f in table.read(spark).inputFiles()]


def scanned(df):
    """Rows that the scan of a plain filter hands on: those of the row groups it did not skip."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def row_groups(paths, keep):
    """(all row groups, those whose value range may hold one of ``keep``) by the files' own footers."""
    total = possible = 0
    for path in paths:
        meta = pq.ParquetFile(path).metadata
        for g in range(meta.num_row_groups):
            at = next(c for c in range(meta.num_columns) if meta.row_group(g).column(c).path_in_schema == "k")
            stats = meta.row_group(g).column(at).statistics
            total += 1
            possible += any(stats.min <= k <= stats.max for k in keep)
    return total, possible


def test_files_are_sorted_by_key_within_a_day(spark, big):
    for path in files(big, spark):
        keys = [k for k in pq.read_table(path, columns=["k"], partitioning=None)["k"].to_pylist() if k is not None]
        assert keys == sorted(keys)
    total, possible = row_groups(files(big, spark), [name(0)])
    assert total > DAYS and possible <= DAYS  # the sort leaves one row group a file to look at


@pytest.mark.parametrize("n", [1, 40])
def test_a_lookup_reads_fewer_row_groups_than_the_table_has(spark, big, n):
    wanted = [name(DAYS * i) for i in range(n)]  # all of them lie in the first day
    whole = scanned(big.read(spark))
    with looked_up(big.read(spark), "k", wanted) as found:
        read = scanned(found)
        assert rows(found, "k") == [(k,) for k in sorted(wanted)]
    assert whole == DAYS * PER_DAY + 1
    # Bloom filters rule out the other days, whose ranges hold the keys as well
    assert read <= whole / DAYS * 1.5


def test_without_filters_the_other_days_would_be_read(spark, big):
    """Keys that no row has, but that lie inside the range of a row group of every day."""
    absent = [name(-1 - i) for i in range(20)]
    total, possible = row_groups(files(big, spark), absent)
    with looked_up(big.read(spark), "k", absent) as found:
        assert possible > total / 10 and scanned(found) <= big.read(spark).count() / 10


def test_upserts_look_up_few_keys_and_join_many(spark, tmp_path, monkeypatch):
    seen = []
    original = snapshots.changed_rows
    monkeypatch.setattr(snapshots, "changed_rows", lambda target, *a: seen.append(target) or original(target, *a))
    rng = random.Random(5)
    for most in (snapshots.FEW_KEYS, 3):
        monkeypatch.setattr(few_values, "__defaults__", (most,))
        table = SnapshotTable(f"{tmp_path}/t{most}", SCHEMA, "d", key="k")
        held = frame(spark, [(name(i), rng.randrange(5), i % 3) for i in range(30)] + [(None, 1, 0), (None, 2, 1)])
        table.replace(held)
        held = rows(held)
        for _ in range(3):
            source = frame(spark, [(name(rng.randrange(40)), rng.randrange(9), rng.randrange(4))] + [(name(50 + i), 1, i) for i in range(4)] + [(None, 9, 2)])
            wanted = rows(merge_rows(spark.createDataFrame(held, SCHEMA), source, ["k"], not_older("v")))
            before = spark.conf.get(PUSHED)
            upsert(table, source, ["k"], not_older("v"))
            assert spark.conf.get(PUSHED) == before
            held = rows(table.read(spark))
            assert held == wanted
    looked = ["IN (" in t._jdf.queryExecution().optimizedPlan().toString() for t in seen]
    assert looked == [True] * 3 + [False] * 3


def test_no_key_at_all(spark, tmp_path):
    table = SnapshotTable(f"{tmp_path}/t", SCHEMA, "d", key="k")
    table.replace(frame(spark, [("a", 1, 0)]))
    upsert(table, frame(spark, [(None, 2, 1)]), ["k"])
    assert len(rows(table.read(spark))) == 2


def test_few_values(spark):
    assert few_values(frame(spark, [("a", 1, 0), ("a", 2, 0), (None, 1, 0)]), "k") == ["a"]
    assert few_values(frame(spark, [("a", 1, 0), ("b", 2, 0)]), "k", 1) is None
