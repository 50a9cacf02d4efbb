"""Every registered query against its SQL, and the plans that have to hold at scale."""

import pytest

from __spark_entry__ import entry
from statelake.registry.oracle import ORACLE
from statelake.registry.queries import all_queries as queries
from tests.parity import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(queries()) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, db, name):
    assert compare(spark, db, FOLDER, name) is None


def test_entry(spark):
    df = entry(spark)
    assert "delivery_rate" in df.columns and df.count() > 0


def plan(spark, name, capsys):
    queries()[name](spark, FOLDER).explain()
    return capsys.readouterr().out


def test_scans_read_only_what_is_used(spark, capsys):
    text = plan(spark, "kpi_cancellation", capsys)
    assert "ReadSchema: struct<o_orderstatus:string,o_orderdate:timestamp_ntz>" in text
    text = plan(spark, "distinct_count", capsys)
    assert "ReadSchema: struct<l_orderkey:bigint>" in text


def test_latest_state_limits_groups_before_each_exchange(spark, capsys):
    two_step = plan(spark, "latest_state", capsys)
    assert two_step.count("Partial") == 2 and two_step.count("Exchange hashpartitioning") == 2
    folded = plan(spark, "latest_state_single_pass", capsys)
    assert folded.count("Partial") == 1 and folded.count("Exchange hashpartitioning") == 1


def test_merge_adds_no_exchange_to_its_inputs(spark, capsys):
    text = plan(spark, "merge_guarded", capsys)
    assert text.count("Exchange hashpartitioning") == 2 and "FullOuter" in text


# these run jobs of their own before they return a scan of what was written
WRITERS = {
    "csv_roundtrip", "gold_table_refresh", "ingest_two_batches", "silver_table_two_refreshes", "stored_offsets",
    "stream_to_bronze", "stream_to_silver", "gold_after_interrupted_run", "ingest_nothing_new", "catalog_tables", "sample_with_children",
}


@pytest.mark.parametrize("name", sorted(set(queries()) - WRITERS))
def test_no_nested_loop_or_python_in_any_plan(spark, capsys, name):
    text = plan(spark, name, capsys)
    for node in ("NestedLoop", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in text
