import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, hits int, rank string, component_id long, size string, block string, removed string, left int, words int"


@pytest.fixture
def documents(spark):
    """Makes documents of (doc_id, text, source) rows, with columns whose names the operators use themselves."""

    def make(rows):
        return spark.createDataFrame([(r[0], r[1], None, r[2] if len(r) > 2 else "s", None, 1, "x", 7, "big", None, "r", 2, 3) for r in rows], DOCS)

    return make
