from pyspark.sql import functions as F

import corpus_pipeline
from statelake.llm import oracle, queries
from statelake.llm.common import stored
from tests.llm.corpora import CLEAN, PASSAGE
from tests.parity import compare, connect

FOLDER = "/root/testdata/sf0.001"


def text_of(k):
    return f"{CLEAN} " + " ".join(f"{w}{k}" for w in CLEAN.split())


def test_every_stage_acts_and_keeps_clean_documents(spark, tmp_path):
    rows = [(k, text_of(k), "en", f"s{k % 3}", 1) for k in range(40)]
    rows += [(50, text_of(3), "en", "s1", 1), (51, "too short", "en", "s1", 1), (52, PASSAGE, "en", "s2", 1)]
    rows += [(53, text_of(53) + " token = abcdefghijklmnop", "en", "s2", 1), (54, None, None, None, None), (4, text_of(4), "en", "s1", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = docs.withColumns({c: F.lit("mine") for c in ("kept", "spans", "n_words", "score")})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1, 0) for k in range(54) if k != 51], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, PASSAGE)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now, left = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stored(stage(spark, now, str(tmp_path)), "test")
        assert now.columns == docs.columns
        left[name] = {r["doc_id"]: r["text"] for r in now.collect()}
        assert now.count() == len(left[name]) + ("quality" in name)  # the repeated row goes with near-duplicates
    good = set(range(40)) | {53}
    assert set(left["quality rules"]) == good | {50, 52} and set(left["simhash near-dedup"]) == good | {52}
    assert set(left["benchmark decontamination"]) == good
    assert left["secret scans"][53].endswith(" [SECRET]") and left["secret scans"][5] == text_of(5)
    done = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in done} == good and all(r["taken"] <= 2 * r["size"] for r in done)


def test_queries_with_sql_equal_it(spark):
    db = connect(FOLDER)
    for name in oracle.ORACLE:
        assert name in queries.all_queries() and compare(spark, db, FOLDER, name) is None
