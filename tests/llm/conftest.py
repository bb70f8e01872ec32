import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def frame(spark):
    """Rows of (doc_id, text) as a documents table."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], DOCS)
    return make
