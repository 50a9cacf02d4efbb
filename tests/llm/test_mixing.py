import collections

from statelake.llm.mixing import MixRules, mix
from tests.llm.corpora import DOCUMENTS, WORD


def filled(sizes, rules):
    """Targets by repeated resharing, as the rule is stated."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: rules.weights[k % len(rules.weights)] for k, s in enumerate(names)}
    capped = set()
    while True:
        rest = rules.share * sum(sizes.values()) - sum(rules.cap * sizes[s] for s in capped)
        open_ones = [s for s in names if s not in capped]
        level = rest / max(sum(weight[s] for s in open_ones), 1)
        over = {s for s in open_ones if level * weight[s] > rules.cap * sizes[s]}
        if not over:
            return {s: rules.cap * sizes[s] if s in capped else level * weight[s] for s in names}
        capped |= over


def test_targets_and_taken_words(docs):
    rules = MixRules()
    size = [len(WORD.findall(t or "")) for _, t, _ in DOCUMENTS]
    sizes = collections.Counter()
    for (_, _, s), n in zip(DOCUMENTS, size, strict=True):
        sizes[s] += n
    targets = filled(sizes, rules)
    rows = mix(docs, rules).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in rows) == sorted((str(i), n) for (i, _, _), n in zip(DOCUMENTS, size, strict=True))
    by_size = collections.defaultdict(list)
    for r in rows:
        by_size[r["source_size"]].append(r)
    for s, total in sizes.items():
        own = by_size[total]
        assert abs(own[0]["target"] - targets[s]) < 1e-6 and abs(sum(r["taken"] for r in own) - targets[s]) < 1
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)


def test_positions_are_sorted_and_reruns_agree(docs):
    first, again = mix(docs).collect(), mix(docs.repartition(5)).collect()
    places = [r["position"] for r in first if r["position"] is not None]
    assert places == sorted(places) and all(0 <= p < 1 for r in first for p in r["positions"])
    assert all((r["position"] is None) == (r["taken"] == 0) for r in first)
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"], str(r["positions"]))
    assert sorted(map(key, first)) == sorted(map(key, again))


def test_a_rising_source_comes_later(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "abc"[i % 3]) for i in range(300)], "doc_id bigint, text string, source string")
    mean = collections.defaultdict(list)
    for r in mix(docs, MixRules(weights=(1,))).join(docs, "doc_id").collect():
        mean[r["source"]].extend(r["positions"])
    a, b, c = (sum(mean[s]) / len(mean[s]) for s in "abc")
    assert a < b < c


def test_only_empty_texts_and_empty_table(spark, no_docs):
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id bigint, text string, source string")
    assert [(r["size"], r["taken"], r["target"]) for r in mix(blank).collect()] == [(0, 0, 0.0)] * 2
    assert mix(no_docs).count() == 0
