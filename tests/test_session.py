"""Task sizes follow the inputs, and go back afterwards."""

import pytest

from statelake import session
from statelake.session import begin_query, fit_session, input_bytes, scratch_dropped, scratch_path, shuffle_partitions_for, sized
from statelake.sources.paths import exists

WIDTH = "spark.sql.shuffle.partitions"


def test_widths_follow_the_bytes():
    assert shuffle_partitions_for(0) == 8 and shuffle_partitions_for(10 * 1024**4) == 245_760
    assert shuffle_partitions_for(100 * 1024**4) == session.MAX_SHUFFLE_PARTITIONS


def test_a_job_over_large_inputs_is_wide_and_leaves_no_trace(spark, tmp_path, monkeypatch):
    before = spark.conf.get(WIDTH)
    spark.range(10).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert 0 < input_bytes(df) < 100_000
    monkeypatch.setattr(session, "size_in_bytes", lambda spark, path: 2 * 1024**4)
    with sized(spark, df, paths=("/declared",)):
        assert int(spark.conf.get(WIDTH)) >= 49_152
    assert spark.conf.get(WIDTH) == before


def test_one_query_does_not_widen_the_next(spark, monkeypatch):
    before = spark.conf.get(WIDTH)
    monkeypatch.setattr(session, "size_in_bytes", lambda spark, path: 1024**4)
    fit_session(spark, "/declared")
    assert int(spark.conf.get(WIDTH)) == 24_576
    begin_query(spark)
    assert spark.conf.get(WIDTH) == before
    fit_session(spark, "/declared")
    spark.conf.set(WIDTH, "17")  # set by hand meanwhile
    begin_query(spark)
    assert spark.conf.get(WIDTH) == "17"
    spark.conf.set(WIDTH, before)


def test_scratch_of_a_block_goes_and_other_scratch_stays(spark):
    def written(label):
        path = scratch_path(spark, label)
        spark.range(3).write.parquet(path)
        return path

    before = written("before")
    with scratch_dropped(spark) as kept:
        inner, result = written("inner"), written("result")
        kept.add(result)
        with pytest.raises(OSError), scratch_dropped(spark):
            nested = written("nested")
            raise OSError("gone")
        assert exists(spark, inner) and not exists(spark, nested)
    assert [exists(spark, p) for p in (before, inner, result)] == [True, False, True]
    assert spark.sparkContext.applicationId in before
