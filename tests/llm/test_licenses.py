import random

import pytest

from statelake.llm.license_texts import PHRASES, TEMPLATES
from statelake.llm.licenses import license_scan
from tests.llm.corpora import CLEAN, DOCUMENTS, plain_words


def phrases(text):
    words, places, labels = plain_words(text), [], set()
    for phrase, label in PHRASES:
        own = phrase.split()
        for k in range(len(words) - len(own) + 1):
            if words[k : k + len(own)] == own:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_phrases(docs):
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    got = sorted((tuple(r) for r in license_scan(docs, ["doc_id"]).select(*columns).collect()), key=str)
    assert got == sorted(((i, *phrases(t)) for i, t, _ in DOCUMENTS), key=str)


def scan(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: r for r in license_scan(df, ["doc_id"]).collect()}


def test_templates_with_edits_are_found_where_they_stand(spark):
    words = TEMPLATES[0][1].split()
    edited = " ".join([*words[:30], "inserted", "words", *words[30:60], *words[62:]])
    half = " ".join(words[: len(words) // 2])
    found = scan(spark, f"{CLEAN} {edited} {CLEAN}", half, CLEAN, "Licensed under CC BY-NC 4.0.", None)
    first = found[0]
    assert first["labels"] == "mit" and 0.8 <= first["score"] < 1 and first["base_labels"] == ""
    span = first["spans"][0]
    assert abs(span["start"] - len(plain_words(CLEAN))) <= 2 and abs(span["end"] - span["start"] - len(plain_words(edited))) <= 4
    assert found[1]["labels"] == "" and found[2]["score"] == 0 and found[4]["n_words"] == 0
    assert found[3]["labels"] == "cc-by-nc" and found[3]["score"] == 1.0


def covered(found):
    at = sorted(set(found))
    return sum(min(5, b - a) for a, b in zip(at, [*at[1:], at[-1] + 5])) if at else 0


def brute(text, templates, slack=8, similarity=0.8):
    """Labels and best score, run by run, from plain words."""
    words, labels, best = plain_words(text), set(), 0.0
    for label, template in templates:
        own = plain_words(template)
        places = {}
        for at in range(len(own) - 4):
            places.setdefault(tuple(own[at : at + 5]), []).append(at)
        votes = {}
        for k in range(len(words) - 4):
            for at in places.get(tuple(words[k : k + 5]), []):
                votes.setdefault(k - at, set()).add(at)
        runs, last = [], None
        for d in sorted(votes):
            fresh = last is None or d - last > slack or 2 * len(votes[d] & votes[last]) > min(len(votes[d]), len(votes[last]))
            runs.append(set(votes[d])) if fresh else runs[-1].update(votes[d])
            last = d
        for run in runs:
            score = covered(run) / len(own)
            if score >= similarity:
                labels.add(label)
                best = max(best, score)
    return labels, best


def mangled(rng, text):
    words = text.split()
    for _ in range(rng.randrange(0, 6)):
        at = rng.randrange(len(words))
        words[at : at + rng.randrange(0, 4)] = ["extra"] * rng.randrange(0, 4)
    return " ".join(words)


def test_labels_and_scores_equal_brute_force(spark):
    rng = random.Random(4)
    texts = [CLEAN]
    for _ in range(60):
        pieces = [mangled(rng, rng.choice(TEMPLATES)[1]) for _ in range(rng.randrange(1, 4))]
        texts.append(f" {CLEAN} ".join(pieces) if rng.random() < 0.5 else " ".join(pieces))
    texts += [t for _, t, _ in DOCUMENTS]
    found = scan(spark, *texts)
    for k, text in enumerate(texts):
        labels, best = brute(text, TEMPLATES)
        assert found[k]["labels"] == ",".join(sorted(labels | set(filter(None, phrases(text)[4].split(","))))) and abs(found[k]["score"] - best) < 1e-12


def test_copies_side_by_side_are_spans_of_their_own(spark):
    short, long = TEMPLATES[1][1], TEMPLATES[0][1]
    found = scan(spark, f"{short} {short} and {short}", f"{long} {long}")
    assert [(s["start"], s["end"]) for s in found[0]["spans"] if s["label"] == "mit"] == [(0, 5), (5, 10), (11, 16)]
    n = len(plain_words(long))
    assert [(s["start"], s["end"]) for s in found[1]["spans"]] == [(0, n), (n, 2 * n)]


def test_templates_and_phrases_of_ones_own(spark):
    own = [("house", "You may do with these words whatever you please as long as you smile")]
    df = spark.createDataFrame([(1, f"{CLEAN} {own[0][1]} {CLEAN}"), (2, TEMPLATES[0][1] + " see the house rules")], "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in license_scan(df, ["doc_id"], templates=own, phrases=[("house rules", "rules")]).collect()}
    assert (found[1]["labels"], found[1]["score"]) == ("house", 1.0) and (found[2]["labels"], found[2]["score"], found[2]["n_base"]) == ("rules", 0.0, 1)
    none = license_scan(df, ["doc_id"], templates=[], phrases=[]).collect()
    assert [(r["labels"], r["n_base"]) for r in none] == [("", 0)] * 2
    with pytest.raises(ValueError):
        license_scan(df, ["doc_id"], templates=[("x", "too short a text")])


def test_every_template_finds_itself(spark):
    found = scan(spark, *[text for _, text in TEMPLATES])
    for k, (label, _) in enumerate(TEMPLATES):
        assert label in found[k]["labels"].split(",") and found[k]["score"] == 1.0


def test_empty_table(no_docs):
    assert license_scan(no_docs, ["doc_id"]).count() == 0
