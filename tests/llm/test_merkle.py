import hashlib
import zlib

import duckdb
import pytest

from statelake.llm.merkle import TreeRules, manifest
from statelake.llm.oracle import OP12_SQL, crc32_sql
from tests.llm.corpora import lower


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes, fanout):
    """The top node, and for every node the (before, after) siblings of each level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            low = k // fanout * fanout
            run = nodes[low : low + fanout]
            paths[i].append(("".join(run[: k - low]), "".join(run[k - low + 1 :])))
        nodes = [h(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
        at = [k // fanout for k in at]
    return nodes[0], paths


def brute(rows, fanout=16):
    leaf = lambda r, text: h(*map(field, (r[0], r[1], r[2], r[3], text)))
    first = lambda v: (v is not None, v)
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    parts = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (first(r[0]), leaf(r, r[4]))) for s in sources}
    trees = {s: tree([leaf(r, r[4]) for r in parts[s]], fanout) for s in sources}
    root, above = tree([trees[s][0] for s in sources], fanout)
    out = []
    for s, up in zip(sources, above):
        for r, path in zip(parts[s], trees[s][1]):
            path = path + up
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
            node = leaf(r, lower(r[4]) if tampered else r[4])
            for before, after in path:
                node = h(before, node, after)
            proof = h(*[a + b for a, b in path])
            out.append((r[0], leaf(r, r[4]), trees[s][0], root, proof, node, node == root, len(path)))
    return sorted(out, key=str)


def table(spark, rows):
    schema = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf int, place string, part string"
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], schema).repartition(3)


def corpus(n):
    sources = [None, "", "b", "é", "z", "hot"]
    rows = [(i, sources[i * i % 5] if i % 3 else "hot", None if i % 7 == 0 else "en", i, None if i % 11 == 0 else f"Text {i % 50} É") for i in range(n)]
    return rows + [(None, "b", None, None, None), (None, "b", None, None, "A"), (3, "hot", "en", 3, "Again"), (3, "hot", "en", 3, "Again"), (n, "one", "de", 1, "")]


@pytest.mark.parametrize("n", [0, 30, 700])
def test_equals_brute_force(spark, n):
    rows = corpus(n)
    assert sorted(map(tuple, manifest(table(spark, rows)).collect()), key=str) == brute(rows)


def test_deep_trees_and_many_sources(spark):
    rows = [(i, f"s{i % 40}" if i % 3 else "hot", "en", 1, f"Text {i}") for i in range(400)]
    got = manifest(table(spark, rows), TreeRules(fanout=2)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 2)
    assert max(r["n_steps"] for r in got) == 8 + 6


def test_one_row_one_source_and_none(spark):
    one = [(1, "a", "en", 2, "Hi")]
    row = manifest(table(spark, one)).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == h()
    assert manifest(table(spark, one).filter("1 = 0")).count() == 0


def test_only_altered_texts_fail(spark):
    rows = corpus(700)
    altered = {r[0] for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] and r[4] != lower(r[4])}
    assert {r["doc_id"] for r in manifest(table(spark, rows)).filter("not verified").collect()} == altered


def test_very_long_text(spark):
    rows = [(i, "a", "en", 1, "Aé" * 1_000_000) for i in range(3)]
    assert sorted(map(tuple, manifest(table(spark, rows)).collect()), key=str) == brute(rows)


def test_equals_sql(spark):
    documents = table(spark, corpus(300)).toPandas().convert_dtypes()  # noqa: F841
    assert sorted(duckdb.sql(OP12_SQL).fetchall(), key=str) == brute(corpus(300))


def test_crc_in_sql():
    for text in ("", "0", "123456789", "-5"):
        assert duckdb.sql(f"SELECT {crc32_sql(chr(39) + text + chr(39))}").fetchall()[0][0] == zlib.crc32(text.encode())

