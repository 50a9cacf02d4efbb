from pyspark.sql import functions as F

from statelake.operators import profile as prof
from statelake.plans.profile import profile_table
from tests.helpers import rows

SCHEMA = "id string, kind string, at string"


def df(spark):
    return spark.createDataFrame([("a", "x", None), ("a", "x", "t"), ("b", "y", None), (None, None, "t")], SCHEMA)


def test_value_counts(spark):
    assert [tuple(r) for r in prof.value_counts(df(spark), "kind").collect()] == [("x", 2), (None, 1), ("y", 1)]
    assert [tuple(r) for r in prof.value_counts(df(spark), "kind", "n", drop_null=True).collect()] == [("x", 2), ("y", 1)]


def test_counts(spark):
    assert prof.row_count(df(spark)).first()[0] == 4
    assert prof.distinct_count(df(spark), "id").first()[0] == 2
    assert prof.distinct_count(df(spark), "id", relative_error=0.05).first()[0] == 2
    assert tuple(prof.null_counts(df(spark)).first()) == (1, 1, 2)


def test_reconcile_matches_drop_duplicates(spark):
    row = prof.reconcile(df(spark), "id").first()
    assert tuple(row) == (4, 3, 1)
    assert row["rows_after"] == df(spark).dropDuplicates(["id"]).count()
    assert tuple(prof.reconcile(df(spark).limit(0), "id").first()) == (0, 0, 0)
    clean = df(spark).filter("id is not null")
    assert tuple(prof.reconcile(clean, "id").first()) == (3, 2, 1)


def test_top_rows(spark):
    assert [r[0] for r in prof.top_rows(spark.range(10), [F.desc("id")], 3).collect()] == [9, 8, 7]


def test_profile_table(spark):
    result = profile_table(df(spark), "id", "kind", ["at"])
    assert rows(result["category"]) == [("x", 2), ("y", 1)]
    assert [result[k].first()[0] for k in ("nulls", "rows", "keys")] == [2, 4, 2]
