import collections
import math
import zlib

import numpy as np
import pytest

from statelake.llm.katz import END, KatzRules, counted, discounts, pack, scored, unpack
from tests.llm.corpora import DOCUMENTS, WORD, lower


def tokens(text):
    return [*WORD.findall(lower(text or "")), None]


def is_held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


class Model:
    """The same model over a whole vocabulary, with dictionaries."""

    def __init__(self, texts):
        self.unigram, self.bigram = collections.Counter(), collections.Counter()
        for words in texts:
            self.unigram.update(words)
            self.bigram.update(zip([None, *words], words, strict=False))
        self.total = self.unigram.total()
        self.factors = self._factors(self.unigram)
        seen = sum(self._discounted(c, self.factors) for c in self.unigram.values()) / self.total
        self.unseen = max(1 - seen, 1 / (self.total + 1))
        self.scale = (1 - self.unseen) / seen
        self.pair_factors = self._factors(self.bigram)
        self.context = collections.defaultdict(dict)
        for (a, b), c in self.bigram.items():
            self.context[a][b] = c

    def _factors(self, counts):
        sizes = collections.Counter(counts.values())
        return discounts([sizes[r] for r in range(1, 7)])

    @staticmethod
    def _discounted(c, factors):
        return c * (factors[c - 1] if c <= len(factors) else 1.0)

    def one(self, w):
        c = self.unigram[w]
        return self.scale * self._discounted(c, self.factors) / self.total if c else self.unseen

    def two(self, a, b):
        followers = self.context.get(a)
        if not followers:
            return self.one(b)
        n = sum(followers.values())
        kept = sum(self._discounted(c, self.pair_factors) for c in followers.values())
        mass = sum(self.one(w) for w in followers)
        free, scale = 1 - kept / n, 1.0
        if 1 - mass <= 1e-9:
            scale, free = n / kept, 0.0
        elif free <= 1e-12:
            scale, free = n / (n + 1), 1 / (n + 1)
        if b in followers:
            return scale * self._discounted(followers[b], self.pair_factors) / n
        return free / (1 - mass) * self.one(b)


def check(df, rows, rules):
    model = Model([tokens(t) for i, t in rows if not is_held(i)])
    n, v = model.total, len(model.unigram)
    want = []
    for i, text in rows:
        words = tokens(text)
        base = sum(math.log10((model.unigram[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        score = sum(math.log10(model.two(a, b)) for a, b in zip([None, *words], words, strict=False))
        want.append((i, is_held(i), len(words), sum(model.unigram[w] > 0 for w in words), n, base, score))
    got = [tuple(r) for r in scored(df, rules).collect()]
    for a, b in zip(sorted(got, key=str), sorted(want, key=str), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-6)
        if rules.frequent >= v:
            assert a[6] == pytest.approx(b[6], abs=1e-6)
        assert math.isfinite(a[6]) and a[6] <= 1e-9


@pytest.mark.parametrize("hot", [1 << 19, 3])
def test_scores_equal_a_plain_model(docs, hot):
    check(docs, [(i, t) for i, t, _ in DOCUMENTS], KatzRules(hot=hot, part_tokens=3000))


def test_rare_words_keep_their_counts(docs):
    check(docs, [(i, t) for i, t, _ in DOCUMENTS], KatzRules(frequent=40, hot=10, part_tokens=3000))


@pytest.mark.parametrize(("frequent", "hot"), [(40, 10), (40, 1 << 19), (1, 1), (1 << 19, 10)])
def test_bounds_do_not_change_scores(docs, frequent, hot):
    """Bigrams and contexts of words that are not broadcast keep their own counts."""
    rows = [(i, t) for i, t, _ in DOCUMENTS]
    model = Model([tokens(t) for i, t in rows if not is_held(i)])
    pairs = [zip([None, *tokens(t)], tokens(t), strict=False) for _, t in rows]
    want = sorted((str(i), sum(math.log10(model.two(a, b)) for a, b in p)) for (i, _), p in zip(rows, pairs, strict=True))
    got = sorted((str(r["doc_id"]), r["score"]) for r in scored(docs, KatzRules(frequent=frequent, hot=hot, part_tokens=3000)).collect())
    for a, b in zip(got, want, strict=True):
        assert a == (b[0], pytest.approx(b[1], abs=1e-6))


def test_every_context_sums_to_one():
    model = Model([tokens(t) for _, t, _ in DOCUMENTS])
    words = [*model.unigram, "never seen"]
    for context in [None, "the", "runs", "once", "ab", "never seen"]:
        assert sum(model.two(context, w) for w in words) == pytest.approx(1.0)


def test_without_training_rows(spark, no_docs):
    held = next(i for i in range(100) if is_held(i))
    df = spark.createDataFrame([(held, "some words")], "doc_id bigint, text string")
    assert tuple(scored(df).first())[1:] == (True, 3, 0, 0, 0.0, 0.0)
    assert scored(no_docs).count() == 0


def test_blocks_survive_packing():
    keys, counts = counted(np.random.default_rng(0).integers(0, 2**63, 1000).astype(np.uint64) % np.uint64(700))
    a, b = unpack(pack(keys, counts))
    assert (a == keys).all() and (b == counts).all() and END > 0
