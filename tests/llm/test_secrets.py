import hashlib
import re

from statelake.llm.secrets import SecretRules, redact, secrets
from tests.llm.corpora import DOCUMENTS

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    found = [("assign", m) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    found += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    found += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    order = ["assign", "access", "hex"]
    return sorted((m.start(), order.index(k), m.end(), k) for k, m in found)


def test_base_spans(docs):
    want = []
    for i, text, _ in DOCUMENTS:
        spans = base(text or "")
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in spans).encode()).hexdigest()
        want.append((i, *[sum(s[3] == k for s in spans) for k in ("assign", "access", "hex")], digest))
    got = [tuple(r) for r in secrets(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_owner_specific_strings_are_added_and_copied_ones_are_not(docs):
    spans = {r["doc_id"]: r["spans"] for r in secrets(docs).collect()}
    assert spans[15] == "generic:10:34" and spans[16] == spans[17] == ""


def test_a_value_in_many_repositories_of_one_owner_is_shared(spark):
    many, few = "Wd93kfLq02mZx8Yt61Bn7c", "Qp47vbNs58hTe2Ru90Lk3d"
    rows = [(k, f"key {many} here", "one") for k in range(11)] + [(k, f"and {few} there", "one") for k in range(100, 110)]
    rows += [(100, f"and {few} there", "one"), (500, "token = abcdefabcdefGH", "one"), (None, "token = abcdefabcdefGH", None)]
    found = {(r["doc_id"], r["spans"]): (r["n_live"], r["n_shared"]) for r in secrets(spark.createDataFrame(rows, "doc_id int, text string, source string")).collect()}
    assert all(found[(k, "")] == (0, 0) for k in range(11))  # an added kind, so not reported
    assert {v for (i, _), v in found.items() if i is not None and 100 <= i < 110} == {(1, 0)}
    assert found[(500, "assign:0:22")] == found[(None, "assign:0:22")] == (0, 1)  # two owners
    lax = secrets(spark.createDataFrame(rows, "doc_id int, text string, source string"), SecretRules(max_repositories=11, max_owners=2))
    assert lax.filter("n_shared > 0").count() == 0


def test_redaction_takes_every_span_out(docs):
    after = {r["doc_id"]: r["text"] for r in redact(docs).collect()}
    assert "hunter2hunter2" not in after[13] and "abcdefghijklmnop" not in after[13] and "TOKEN=short" in after[13]
    assert after[14].count("[SECRET]") == 4 and "😀" in after[14]
    assert after[15] == "the value [SECRET] is mine" and "Example1" in after[16]
    assert after[1] is None and after[2] == "" and redact(docs).count() == len(DOCUMENTS)
    assert redact(docs).columns == docs.columns and {r["spans"] for r in redact(docs).collect()} == {"mine"}


def test_overlapping_spans_become_one(spark):
    docs = spark.createDataFrame([(1, "x token=deadbeefdeadbeefdeadbeef y", "a")], "doc_id bigint, text string, source string")
    assert redact(docs).first()["text"] == "x [SECRET] y"


def test_empty_table(no_docs):
    assert secrets(no_docs).count() == 0 and redact(no_docs).count() == 0
