import datetime as dt

import pytest
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from statelake.sources import checked_csv
from statelake.sources.checked_csv import header_names, read_checked_csv
from tests.helpers import rows

SCHEMA = StructType([StructField("id", IntegerType()), StructField("name", StringType()), StructField("day", DateType())])
DAY = dt.date(2024, 1, 2)


def write(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_good_lines_and_rejects(spark, tmp_path):
    path = write(tmp_path, a='id,name,day\n1,"x, y",2024-01-02\n2,short\n3,a,2024-01-02,more\nfour,b,2024-01-02\n5,,\n6,c,yesterday\n', b="id,name,day\n7,z,2024-01-02\n")
    good, bad = read_checked_csv(spark, path, SCHEMA)
    assert good.schema == SCHEMA and rows(good) == [(1, "x, y", DAY), (5, None, None), (7, "z", DAY)]
    assert rows(bad, "line", "reason") == [
        ("2,short", "fields: 2"), ("3,a,2024-01-02,more", "fields: 4"),
        ("6,c,yesterday", "a value does not fit its type"), ("four,b,2024-01-02", "a value does not fit its type"),
    ]
    assert {r["file"].rsplit("/", 1)[1] for r in bad.collect()} == {"a.csv"}
    assert good.count() == good.select("name").count() == 3 and bad.count() == 4  # whatever is asked for


def test_columns_are_found_by_name(spark, tmp_path):
    path = write(tmp_path, a="id,name,day\n1,a,2024-01-02\n", b="day,id,name\n2024-01-02,2,b\nx,3,c\n", c='more,day,"name",id\nm,2024-01-02,d,4\n')
    good, bad = read_checked_csv(spark, path, SCHEMA)
    assert rows(good) == [(1, "a", DAY), (2, "b", DAY), (4, "d", DAY)]
    assert rows(bad, "line", "reason") == [("x,3,c", "a value does not fit its type")]


def test_files_with_headers_that_cannot_serve_are_set_aside(spark, tmp_path):
    path = write(tmp_path, a="id,name\n1,a\n", b="id,name,day,id\n1,a,2024-01-02,2\n", c="id,name,day\n3,c,2024-01-02\n", d="", e="id,name,day\n")
    good, bad = read_checked_csv(spark, path, SCHEMA)
    assert rows(good) == [(3, "c", DAY)]
    assert rows(bad, "line", "reason") == [("1,a", "header lacks day"), ("1,a,2024-01-02,2", "header repeats id")]


def test_many_files_in_one_task_keep_their_own_headers(spark, tmp_path):
    for i in range(40):
        names = ["id,name,day", "name,day,id", "day,id,name"][i % 3]
        values = {"id": str(i), "name": f"n{i}", "day": "2024-01-02"}
        (tmp_path / f"f{i}.csv").write_text(names + "\n" + ",".join(values[n] for n in names.split(",")) + "\n")
    good, bad = read_checked_csv(spark, str(tmp_path), SCHEMA)
    assert rows(good) == sorted(((i, f"n{i}", DAY) for i in range(40)), key=lambda r: (False, str(r[0]))) and bad.count() == 0


def test_too_many_headers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(checked_csv, "MAX_HEADERS", 1)
    with pytest.raises(ValueError):
        read_checked_csv(spark, write(tmp_path, a="id,name,day\n", b="day,id,name\n"), SCHEMA)


def test_header_names():
    assert header_names('\ufeffid,"a,b", x') == ["id", "a,b", "x"]
