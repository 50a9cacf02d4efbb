import itertools
import random

import numpy as np
import xxhash

from statelake.llm.components import components
from statelake.llm.simhash import fingerprint, links, links_within, near_duplicates, one_of_each, signatures
from tests.llm.corpora import CLEAN, DOCUMENTS, LONG, WORD, lower


def print_of(text):
    w = WORD.findall(lower(text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    """Index of the first member reachable over links of at most two bits, for every member."""
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 2:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprints():
    for _, text, _ in DOCUMENTS:
        assert fingerprint(text) == print_of(text)


def test_documents(docs):
    prints = [print_of(t) for _, t, _ in DOCUMENTS]
    groups = classes(prints)
    ids = {}
    for (i, _, _), g in zip(DOCUMENTS, groups, strict=True):
        if i is not None:
            ids[g] = min(i, ids.get(g, i))
    want = sorted(((i, f"{p:016x}", ids.get(g)) for (i, _, _), p, g in zip(DOCUMENTS, prints, groups, strict=True)), key=str)
    assert sorted((tuple(r) for r in near_duplicates(docs).collect()), key=str) == want


def random_prints(n, spread):
    rng = random.Random(n)
    seeds = [rng.getrandbits(64) for _ in range(5)]
    made = set()
    while len(made) < n:
        value = rng.choice(seeds)
        for _ in range(rng.randrange(spread)):
            value ^= 1 << rng.randrange(64)
        made.add(value)
    return sorted(made)


def test_no_link_is_missed(spark):
    prints = random_prints(400, 5)
    frame = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "fp bigint")
    got = {frozenset(x % 2**64 for x in r) for r in links(frame).collect()}
    assert got == {frozenset(p) for p in itertools.combinations(prints, 2) if (p[0] ^ p[1]).bit_count() <= 2}


def test_pairs_within_two_bits_share_a_signature():
    rng = random.Random(3)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
        keys = signatures(np.array([a, b], dtype=np.uint64))
        assert set(keys[0]) & set(keys[1])


def test_large_groups_look_up_their_neighbours():
    prints = np.array([x << 20 for x in range(2000)], dtype=np.uint64)
    left, right = links_within(np.zeros(len(prints), np.int64), prints)
    want = sum((a ^ b).bit_count() <= 2 for a, b in itertools.combinations(range(2000), 2))
    assert len(left) == want and ((left ^ right) != 0).all()


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, 500 + i) for i in range(1, 40)] + [(900, 900)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {i: 0 for i in range(1, 101)} | {500 + i: 500 for i in range(1, 40)}


def test_one_of_each(docs):
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 4 in ids and 5 not in ids and 1 in ids and 2 not in ids


def test_rows_that_share_an_id_but_no_text_all_stay(spark):
    other = "nothing of what stands here occurs in any of the other texts of this small table of three"
    rows = [(1, LONG, "a"), (1, CLEAN, "b"), (2, other, "c"), (1, CLEAN, "d"), (None, LONG, "e"), (None, "one more", "f")]
    kept = one_of_each(spark.createDataFrame(rows, "doc_id int, text string, __key string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(1, LONG), (1, CLEAN), (2, other), (0, "one more")])


def test_empty_table(no_docs):
    assert near_duplicates(no_docs).count() == 0 and one_of_each(no_docs).count() == 0
