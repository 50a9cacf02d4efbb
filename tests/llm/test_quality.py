import collections
import math

import xxhash
from pyspark.sql import functions as F

from statelake.llm.quality import COUNTS, QualityRules, quality
from tests.llm.corpora import DOCUMENTS, WORD

RULES = QualityRules(buckets=64)


def model(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    seen = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(hit)


def grams(text):
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORD.findall(text or "")]
    pairs = []
    for i, x in enumerate(h):
        value = xxhash.xxh64_intdigest(x.to_bytes(8, "little"), 42)
        if i + 1 < len(h):
            value = xxhash.xxh64_intdigest(h[i + 1].to_bytes(8, "little"), value)
        pairs.append(value)
    signed = [v - 2**64 if v >= 2**63 else v for v in h + pairs]
    return [v % RULES.buckets for v in signed]


def expected(trusted):
    raw, good = collections.Counter(), collections.Counter()
    for i, text, _ in DOCUMENTS:
        raw.update(grams(text))
        if i in trusted:
            good.update(grams(text))
    level = math.log((raw.total() + RULES.buckets) / (good.total() + RULES.buckets))
    weight = {b: round(math.log((good[b] + 1) / (raw[b] + 1)) + level, 6) for b in raw} if good else {}
    result = []
    for i, text, _ in DOCUMENTS:
        counts, g = model(text), grams(text)
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        score = sum(weight.get(b, 0.0) for b in g) / len(g) if g else 0.0
        result.append((i, *counts, failed, round(score, 6), not failed and score >= RULES.threshold))
    return sorted(result, key=str)


def found(df):
    rows = df.select("doc_id", *COUNTS, "base_failed", F.round("score", 6), "kept").collect()
    return sorted((tuple(r) for r in rows), key=str)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_counts_and_verdict(spark, docs):
    marked = labels(spark, [(4, 1, 0), (4, 1, 0), (9, 1, 0), (7, 1, 1), (12, 0, 0), (None, 1, 0), (8, None, None)])
    got, want = found(quality(docs, marked, RULES)), expected({4, 9})
    assert [r[:7] + r[8:] for r in got] == [r[:7] + r[8:] for r in want]
    assert all(abs(a[7] - b[7]) < 1e-5 for a, b in zip(got, want, strict=True))


def test_without_trusted_documents_the_ratio_rejects_nothing(spark, docs):
    rows = quality(docs, labels(spark, []), RULES).collect()
    assert all(r["score"] == 0 and r["kept"] == (not r["base_failed"]) for r in rows)


def test_empty_table(spark, no_docs):
    assert quality(no_docs, labels(spark, [(1, 1, 0)]), RULES).count() == 0


def test_a_filter_does_not_repeat_the_hashing(spark, docs, capsys):
    judged = quality(docs, labels(spark, [(4, 1, 0)]), RULES).filter("kept").select("doc_id")
    judged.explain()
    assert capsys.readouterr().out.count("split(") <= 2
