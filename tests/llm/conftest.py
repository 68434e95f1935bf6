import pytest

from gaffer.llm.common import prepare


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(llm):
    """A documents table from (doc_id, text[, source[, lang]]) rows, with columns
    whose names clash with those that operators use inside."""
    def make(rows):
        full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "src0", 7, "x", 1.0, [1], "y", 3, 4, 5, "z") for r in rows]
        return llm.createDataFrame(full, DOCS + ", size string, score double, ids array<int>, _hash string, _copies int, "
                                                "_gone long, _id long, component_id string")
    return make
