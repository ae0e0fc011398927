import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a small documents table; rows are (doc_id, text) or (doc_id, text, lang)."""

    def build(rows, schema=DOCS):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, schema)

    return build
