from pyspark.sql import functions as F

from statelake.functions.clocks import clock, iso_naive, iso_zoned, parse_columns, parse_timestamp, seconds_between
from statelake.functions.counters import other_count, safe_ratio, status_counts
from statelake.functions.identity import random_id, stable_id
from tests.helpers import at


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


def test_iso_text_parses_with_any_fraction_and_zone(spark):
    for text, expected in [
        ("2024-01-01T00:00:00+00:00", at("2024-01-01T00:00:00")),
        ("2024-01-01T00:00:00.5+00:00", at("2024-01-01T00:00:00.500000")),
        ("2024-01-01T02:00:00.000001+02:00", at("2024-01-01T00:00:00.000001")),
        ("2024-01-01T00:00:00", at("2024-01-01T00:00:00")),
        ("2024-01-01 00:00:00", at("2024-01-01T00:00:00")),
    ]:
        assert one(spark, parse_timestamp(F.lit(text)).cast("timestamp_ntz")) == expected


def test_bad_text_gives_null_not_an_error(spark):
    for text in ("junk", "", "2024-13-01T00:00:00", None):
        assert one(spark, parse_timestamp(F.lit(text).cast("string"))) is None


def test_fixed_pattern_loses_times_without_a_fraction(spark):
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    assert one(spark, parse_timestamp(F.lit("2024-01-01T00:00:00+00:00"), pattern)) is None
    assert one(spark, parse_timestamp(F.lit("2024-01-01T00:00:00.000000+00:00"), pattern)) is not None


def test_each_side_is_cut_to_the_second_first(spark):
    later, earlier = F.lit("2024-01-01 00:00:02.1").cast("timestamp"), F.lit("2024-01-01 00:00:00.9").cast("timestamp")
    assert one(spark, seconds_between(later, earlier)) == 2


def test_iso_text_forms(spark):
    t = F.lit("2024-01-01 01:02:03").cast("timestamp")
    assert one(spark, iso_zoned(t)) == "2024-01-01T01:02:03.000000+00:00"
    assert one(spark, iso_naive(t)) == "2024-01-01T01:02:03.000000"


def test_parse_columns_and_clock(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00", "junk")], "a string, b string")
    row = parse_columns(df, ["a", "b"]).first()
    assert row["a"] == at("2024-01-01T00:00:00") and row["b"] is None
    assert one(spark, clock("2024-01-01").cast("timestamp_ntz")) == at("2024-01-01T00:00:00")
    assert one(spark, clock(at("2024-01-01T05:00:00")).cast("timestamp_ntz")) == at("2024-01-01T05:00:00")
    assert one(spark, clock()) is not None


def test_ids(spark):
    df = spark.createDataFrame([("o1", "A"), ("o1", "A"), ("o1", "B")], "order_id string, event_type string")
    ids = [r[0] for r in df.select(stable_id("order_id", "event_type")).collect()]
    assert ids[0] == ids[1] != ids[2] and len(ids[0]) == 64
    fresh = [r[0] for r in df.select(random_id()).collect()]
    assert len(set(fresh)) == 3


def test_counters(spark):
    df = spark.createDataFrame([("A",), ("A",), ("z",), (None,)], "s string")
    wanted = {"a_rows": "A", "b_rows": "B"}
    row = df.agg(F.count("*").alias("n"), *status_counts("s", wanted), other_count("s", wanted, "rest")).first()
    assert (row["n"], row["a_rows"], row["b_rows"], row["rest"]) == (4, 2, 0, 2)
    ratios = spark.createDataFrame([(1, 4), (0, 0)], "p long, w long").select(safe_ratio("p", "w"))
    assert [r[0] for r in ratios.collect()] == [0.25, 0.0]
