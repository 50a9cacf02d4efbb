"""Run registered queries beside their SQL and compare. ``python -m tests.parity [folder] [name ...]``"""

from __future__ import annotations

import sys
import time

import duckdb

from __spark_entry__ import oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return db


def _canonical(frame_columns, records):
    names = sorted(frame_columns)
    place = [frame_columns.index(n) for n in names]
    return names, sorted((tuple(r[i] for i in place) for r in records), key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, db, folder, name):
    """None when equal, else what differs."""
    df = queries()[name](spark, folder)
    left = _canonical(df.columns, [tuple(r) for r in df.collect()])
    relation = db.sql(oracle_sql()[name])
    right = _canonical(relation.columns, relation.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} != {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b or [type(v) for v in a] != [type(v) for v in b]:
            return f"{a} != {b}"
    return None


def main():
    from pyspark.sql import SparkSession

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    db = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, db, folder, name)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
