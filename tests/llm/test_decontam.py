import hashlib

import numpy as np
import pytest

from statelake.llm import decontam
from statelake.llm.decontam import FMIndex, contamination, suffix_array
from tests.llm.corpora import CLEAN, DOCUMENTS, LONG, PASSAGE, plain_words

ITEMS = [
    (1, PASSAGE), (2, CLEAN), (2, "Two words"), (3, None), (4, ""), (5, "indeed"), (10, " ".join(LONG.split()[50:70])),
    (None, "é"), (7, "the the"), (8, CLEAN.upper()),
]


def expected(texts, items):
    windows = {}
    for i, text in items:
        words = plain_words(text)
        n = min(13, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[k : k + n]), set()).add(i)
    result = []
    for i, text in texts:
        words, hit, found = plain_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if own := windows.get(tuple(words[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= own
        named = sorted(str(x) for x in found if x is not None)
        digest = hashlib.sha256(",".join(named).encode()).hexdigest()
        result.append((i, len(words), len(hit), len(named), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(result, key=str)


def found(df, benchmark):
    return sorted((tuple(r) for r in contamination(df, benchmark, ["doc_id"]).drop("removal_spans").collect()), key=str)


@pytest.mark.parametrize("block", [1 << 20, 20])
def test_documents(spark, docs, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", block)
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert found(docs, benchmark) == expected([(i, t) for i, t, _ in DOCUMENTS], ITEMS)


def test_removal_spans_are_merged(spark, docs):
    benchmark = spark.createDataFrame([(1, PASSAGE)], "item_id bigint, text string")
    spans = {r["doc_id"]: r["removal_spans"] for r in contamination(docs, benchmark, ["doc_id"]).collect()}
    assert [tuple(s) for s in spans[8]] == [(3, 3 + len(plain_words(PASSAGE)))] and spans[9] == []


def test_empty_tables(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert not any(r["contaminated"] or r["n_hit"] for r in contamination(docs, none, ["doc_id"]).collect())
    assert contamination(no_docs, none, ["doc_id"]).count() == 0


def test_index_counts_and_locates():
    rng = np.random.default_rng(4)
    for _ in range(40):
        text = rng.integers(0, 4, rng.integers(3, 80))
        text[-1] = 0
        index = FMIndex.of(text, 4)
        for length in (1, 2, 3):
            phrases = rng.integers(1, 4, (20, length))
            lo, hi = index.search(phrases)
            for p, a, b in zip(phrases, lo, hi, strict=True):
                want = [k for k in range(len(text) - length + 1) if (text[k : k + length] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_suffix_array_orders_separators_apart():
    text = np.array([2, 1, 0, 2, 1, 0])
    order = suffix_array(text)
    assert sorted(order.tolist()) == list(range(6)) and set(order[:2].tolist()) == {2, 5}
