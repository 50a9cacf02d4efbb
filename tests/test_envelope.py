import json

from pyspark.sql import functions as F

from statelake.operators.envelope import decode, encode, reject_reason, split_rejects, stamp_event
from statelake.plans.ingest import to_bronze
from statelake.plans.silver import rejected_records
from statelake.schemas import BRONZE_SCHEMA, CORRUPT_COLUMN, EVENT_FIELDS, LOG_SCHEMA
from tests.helpers import at, event, log_rows, rows

GOOD = event("e1", "o1", "ORDER_CREATED", "2024-01-01T00:00:00+00:00", "2024-01-01T00:00:05+00:00")


def test_decode_flattens_and_renames(spark):
    df = decode(log_rows(spark, [GOOD]))
    assert df.columns == [*EVENT_FIELDS, "topic", "partition", "offset", "kafka_timestamp"]
    row = df.first()
    assert row["event_id"] == "e1" and row["event_time"] == GOOD["event_time"]
    assert row["kafka_timestamp"] == at("2024-03-01T00:00:00")


def test_encode_is_keyed_json_in_payload_order(spark):
    df = spark.createDataFrame([tuple(GOOD[f] for f in EVENT_FIELDS)], EVENT_FIELDS)
    row = encode(df).select(F.col("key").cast("string").alias("k"), F.col("value").cast("string").alias("v")).first()
    assert row["k"] == "o1"
    assert json.loads(row["v"]) == GOOD and list(json.loads(row["v"])) == EVENT_FIELDS


def test_round_trip_keeps_nulls_and_text(spark):
    odd = {**GOOD, "customer_id": 'quote " and \\ and ü', "order_status": None}
    df = spark.createDataFrame([tuple(odd[f] for f in EVENT_FIELDS)], ", ".join(f"{f} string" for f in EVENT_FIELDS))
    back = decode(encode(df), metadata={}).first().asDict()
    assert back == odd


def test_stamp_event_sets_three_clocks(spark):
    events = spark.createDataFrame(
        [("e", "o", "c", "SHIPPED", at("2024-01-01T10:00:00"), "shipped")],
        "event_id string, order_id string, customer_id string, event_type string, event_time timestamp, order_status string",
    )
    fixed = F.lit("2024-05-05 00:00:00").cast("timestamp")
    row = stamp_event(events, fixed, fixed).first()
    assert row["original_event_time"] == "2024-01-01T10:00:00.000000"
    assert row["event_time"] == row["ingestion_time"] == "2024-05-05T00:00:00.000000+00:00"
    assert stamp_event(events).first()["event_time"].endswith("+00:00")


def test_rejects_by_reason_and_nothing_lost(spark):
    bad = ["not json", None, {}, {**GOOD, "order_id": None}, {**GOOD, "event_time": "junk"}, {**GOOD, "event_time": None}]
    decoded = decode(log_rows(spark, [GOOD, *bad]), corrupt_column=CORRUPT_COLUMN)
    usable, rejected = split_rejects(decoded)
    assert [r["event_id"] for r in usable.collect()] == ["e1"]
    assert usable.columns == decoded.columns
    assert rows(rejected, "reject_reason") == sorted(
        [("bad_json",), ("missing_event_id",), ("missing_event_id",), ("missing_order_id",), ("bad_event_time",), ("missing_event_time",)],
        key=str,
    )
    assert [r[CORRUPT_COLUMN] for r in rejected.filter("reject_reason = 'bad_json'").collect()] == ["not json"]


def test_rules_are_parameters(spark):
    df = spark.createDataFrame([("a", None), (None, "x")], "k string, note string")
    reason = reject_reason(required=["k"], times=[], corrupt_column=None)
    assert rows(df.select("note", reason.alias("r"))) == [("x", "missing_k"), (None, None)]


def test_raw_layer_keeps_every_record_and_names_rejects(spark):
    raw = to_bronze(log_rows(spark, [GOOD, "not json", None]), "2024-01-01 00:01:00")
    assert raw.columns == BRONZE_SCHEMA.names
    assert raw.count() == 3
    good = raw.filter("event_id = 'e1'").first()
    assert good["lag_sec"] == 55 and good["raw_hour"] == 0 and str(good["raw_date"]) == "2024-01-01"
    assert rejected_records(raw).count() == 2


def test_a_payload_is_parsed_once_however_often_its_fields_are_tested(spark, tmp_path, capsys):
    """Over a JSON source the reject filter would otherwise be pushed through the decoding."""
    log = spark.createDataFrame([(b"k", b"{}", "t", 0, 1, None)], LOG_SCHEMA)
    log.write.parquet(f"{tmp_path}/log")
    usable, _ = split_rejects(to_bronze(spark.read.parquet(f"{tmp_path}/log")))
    usable.explain()
    assert capsys.readouterr().out.count("from_json(") == 1
