import pytest

from tests.llm.corpora import DOCUMENTS


@pytest.fixture(scope="module")
def docs(spark):
    """Hand-written documents: NULLs, empty and white texts, ties, repeated rows and clashing columns."""
    schema = "doc_id bigint, text string, source string, n_words int, spans string, kept string, row int, `__h` string"
    rows = [(i, t, s, -1, "mine", "mine", 7, "mine") for i, t, s in DOCUMENTS]
    return spark.createDataFrame(rows, schema).coalesce(2)


@pytest.fixture(scope="module")
def no_docs(docs):
    return docs.filter("1 = 0")
