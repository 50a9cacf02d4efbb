import hashlib
import itertools
import re

import numpy as np
import pytest

from statelake.llm import suffix
from statelake.llm.induced import suffix_order
from statelake.llm.suffix import joined, removed_spans, repeats_in_shard, strips_of, without_repeats
from tests.llm.corpora import DOCUMENTS


def expected(rows):
    """Rows in the order of the table; ids decide, then that order."""
    seen, result = set(), []
    for i, text in sorted(rows, key=lambda r: -(2**63) if r[0] is None else r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(data[p : p + 100])
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        result.append((i, len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(result, key=str)


def found(df):
    return sorted((tuple(r)[:5] for r in without_repeats(df).collect()), key=str)


def test_documents(docs):
    assert found(docs) == expected([(i, t) for i, t, _ in DOCUMENTS])


def test_repeats_in_part_across_many_texts(spark):
    rng = np.random.default_rng(5)
    parts = ["".join(rng.choice(list("abcé "), 130)) for _ in range(12)]
    rows = [(k, "".join(parts[j][rng.integers(0, 40) :] for j in rng.integers(0, 12, 4))) for k in range(60)]
    rows += [(100, "=" * 700), (101, "-" + "=" * 300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).sortWithinPartitions("doc_id")
    assert found(df) == expected(rows)


def test_empty_table(no_docs):
    assert without_repeats(no_docs).count() == 0


@pytest.mark.parametrize("limit", [10, 10**9])
def test_suffix_and_common_prefix_arrays(limit):
    rng = np.random.default_rng(limit % 97)
    for trial in range(60):
        values = rng.integers(1, rng.integers(2, 5), rng.integers(1, 50))
        text = np.append(np.tile(values, rng.integers(1, 5) if trial % 2 else 1), 0).astype(np.int16)
        order, prefix = suffix_order(text, limit)
        plain = text.tolist()
        want = sorted(range(len(plain)), key=lambda k: plain[k:])
        assert order.tolist() == want
        for k in range(1, len(want)):
            a, b = plain[want[k - 1] :], plain[want[k] :]
            same = next((n for n, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert prefix[k] == min(same, 100)


def test_a_shard_larger_than_its_queues_gives_the_same():
    rng = np.random.default_rng(1)
    base = bytes(rng.integers(97, 101, 400, dtype=np.uint8))
    pieces = [base[k : k + 180] for k in range(0, 200, 7)]
    windows = np.array([len(p) - 99 for p in pieces])
    small, large = repeats_in_shard(pieces, windows, 2_000), repeats_in_shard(pieces, windows)
    assert sorted(zip(*small, strict=True)) == sorted(zip(*large, strict=True)) and len(small[0])


def test_strips_hold_every_window_once():
    data = np.frombuffer(bytes(np.random.default_rng(2).integers(97, 123, 3000, dtype=np.uint8)), np.uint8)
    at = np.array([0, 50, 50, 1200, 3000])
    s = strips_of(data, at)
    got = sorted((t, int(a) + k) for t, a, w in zip(s["text"], s["start"], s["windows"], strict=True) for k in range(w))
    assert got == [(t, k) for t in range(4) for k in range(max(0, at[t + 1] - at[t] - 99))] and s["windows"].max() <= 85


def test_row_numbers_are_made_once(docs):
    numbered, spans = removed_spans(docs)
    for df in (numbered, spans):
        assert "monotonically_increasing_id" not in df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("most", [0, 20_000])
def test_anchors_with_many_surroundings_are_dealt_by_window(spark, most):
    rng = np.random.default_rng(9)
    passage = "".join(rng.choice(list("abcdefgh"), 60))
    sides = ["".join(rng.choice(list("abcdefgh"), 90)) for _ in range(40)]
    rows = [(k, sides[rng.integers(40)] + passage + sides[rng.integers(40)]) for k in range(300)]
    rows += [(k % 7, None if k % 3 else passage) for k in range(9)] + [(None, sides[0] + passage + sides[1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = sorted((tuple(r)[:5] for r in without_repeats(df, shard_bytes=most).collect()), key=str)
    assert got == expected(rows)


def test_strips_do_not_depend_on_chunks(monkeypatch):
    data = np.random.default_rng(4).integers(97, 100, 5000).astype(np.uint8)
    at = np.array([0, 130, 130, 2600, 5000])
    whole = strips_of(data, at)
    for size in (150, 1000):
        monkeypatch.setattr(suffix, "CHUNK", size)
        for name, values in strips_of(data, at).items():
            assert values.tolist() == whole[name].tolist()


@pytest.mark.parametrize("top", [3, 300])
def test_suffix_order_of_long_runs(top):
    """Pieces between minima that take more than one number to compare."""
    rng = np.random.default_rng(top)
    for trial in range(30):
        values = np.repeat(rng.integers(1, top, 9), rng.integers(1, 30, 9))
        text = np.append(np.tile(values, 1 + trial % 2), 0).astype(np.int16)
        plain = text.tolist()
        order, prefix = suffix_order(text)
        assert order.tolist() == sorted(range(len(plain)), key=lambda k: plain[k:])
        for k, (a, b) in enumerate(itertools.pairwise(order.tolist()), 1):
            same = next(n for n in range(len(plain)) if plain[a + n] != plain[b + n])
            assert prefix[k] == min(same, 100)


def test_only_what_is_still_undecided_is_sorted_again(monkeypatch):
    """The sort of a shard takes one pass over its symbols and few over its names, however long its repeats are."""
    rng = np.random.default_rng(8)
    parts = rng.integers(1, 200, (60, 90))
    text = np.append(np.concatenate([parts[j] for j in rng.integers(0, 60, 40)] + [rng.integers(1, 200, 6000)]), 0).astype(np.int16)
    done = []
    for name in ("argsort", "lexsort", "unique"):
        plain = getattr(np, name)
        monkeypatch.setattr(np, name, lambda x, *a, plain=plain, **b: (done.append(np.size(x[-1] if isinstance(x, tuple) else x)), plain(x, *a, **b))[1])
    order, _ = suffix_order(text)
    assert sorted(order.tolist()) == list(range(len(text)))
    assert sum(done) < 4 * len(text)


def test_spans_that_touch_or_overlap_are_one():
    rng = np.random.default_rng(6)
    for _ in range(50):
        row, start = rng.integers(0, 4, 12), rng.integers(0, 40, 12)
        end = start + rng.integers(1, 9, 12)
        inside = np.zeros((4, 60), dtype=bool)
        for r, a, b in zip(row, start, end, strict=True):
            inside[r, a:b] = True
        got = [tuple(int(x) for x in s) for s in zip(*joined(row, [start, end]), strict=True)]
        steps = np.diff(np.pad(inside, ((0, 0), (1, 1))).astype(int))
        assert got == [(r, int(a), int(b)) for r in range(4) for a, b in zip(np.flatnonzero(steps[r] == 1), np.flatnonzero(steps[r] == -1), strict=True)]
