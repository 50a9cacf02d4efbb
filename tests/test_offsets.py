import json

from statelake.operators import offsets as ops
from statelake.operators.offsets import advance_offsets, local_if_small, next_offsets, resume
from statelake.sources.kafka import starting_offsets
from tests.helpers import rows

LOG = "topic string, partition int, offset long"
POSITIONS = "topic string, partition int, next_offset long"


def log(spark):
    return spark.createDataFrame([("t", 0, 5), ("t", 0, 7), ("t", 1, 2), ("u", 0, 0)], LOG)


def test_next_offsets(spark):
    assert rows(next_offsets(log(spark)), "topic", "partition", "next_offset") == [("t", 0, 8), ("t", 1, 3), ("u", 0, 1)]


def test_silent_partition_keeps_its_position(spark):
    stored = spark.createDataFrame([("t", 0, 3), ("t", 9, 44), ("u", 0, 9)], POSITIONS)
    merged = advance_offsets(stored, next_offsets(log(spark)))
    assert rows(merged) == [("t", 0, 8), ("t", 1, 3), ("t", 9, 44), ("u", 0, 9)]


def test_resume_with_and_without_broadcast(spark, monkeypatch):
    stored = spark.createDataFrame([("t", 0, 7)], POSITIONS)
    expected = [("t", 0, 7), ("t", 1, 2), ("u", 0, 0)]
    assert rows(resume(log(spark), stored)) == expected
    monkeypatch.setattr(ops, "MAX_LITERAL_POSITIONS", 0)
    assert rows(resume(log(spark), stored)) == expected
    monkeypatch.setattr(ops, "MAX_BROADCAST_POSITIONS", 0)
    assert rows(resume(log(spark), stored)) == expected


def test_null_slots_count_alike_at_every_number_of_positions(spark):
    records = [("t", 0, 1), ("t", 0, 9), (None, 0, 4), ("t", None, 5), (None, None, 6), ("t", 7000, 0), ("t", 7000, None), (None, 0, -1), ("t", 0, None)]
    awkward = [("t", 0, 3), ("t", 0, 9), ("t", 0, None), (None, 0, 50), ("t", None, 50), ("u", 3, None)]
    frame = spark.createDataFrame([*records, ("u", 3, 0)], LOG)
    expected = {("t", 0, 9), (None, 0, 4), ("t", None, 5), (None, None, 6), ("t", 7000, 0), ("u", 3, 0)}
    for others in (2, 300):
        stored = spark.createDataFrame(awkward + [("v", k, 1) for k in range(others)], POSITIONS)
        got = [tuple(r) for r in resume(frame, stored).collect()]
        assert set(got) == expected and len(got) == len(expected)


def test_resume_from_nothing_reads_all(spark):
    assert resume(log(spark), spark.createDataFrame([], POSITIONS)).count() == 4


def test_local_if_small(spark):
    assert local_if_small(spark.range(3), 3)[1]
    assert not local_if_small(spark.range(4), 3)[1]


def test_starting_offsets_text(spark):
    stored = spark.createDataFrame([("t", 1, 3), ("t", 0, 8), ("u", 0, 1)], POSITIONS)
    assert json.loads(starting_offsets(stored, "t")) == {"t": {"0": 8, "1": 3}}
    assert starting_offsets(None, "t") == "earliest"
    assert starting_offsets(stored, "other") == "earliest"


def test_every_partition_of_the_topic_is_named(spark):
    """One partition never delivered, another was added; both start at their earliest record."""
    stored = spark.createDataFrame([("t", 0, 8), ("t", 2, 3)], POSITIONS)
    assert json.loads(starting_offsets(stored, "t", range(4))) == {"t": {"0": 8, "1": -2, "2": 3, "3": -2}}
    assert starting_offsets(spark.createDataFrame([], POSITIONS), "t", range(4)) == "earliest"


def test_positions_reach_the_scan_of_a_log_in_files(spark, tmp_path, capsys):
    log(spark).write.parquet(f"{tmp_path}/log")
    stored = spark.createDataFrame([("t", 0, 7), ("t", 1, 2)], POSITIONS)
    resume(spark.read.parquet(f"{tmp_path}/log"), stored).explain()
    text = capsys.readouterr().out
    assert "GreaterThanOrEqual(offset,7)" in text.replace(" ", "") and "Join" not in text
