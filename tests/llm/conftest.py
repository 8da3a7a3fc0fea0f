import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a table of documents from ``(doc_id, text[, lang[, source]])`` rows."""

    def build(*rows):
        full = [(*r, *([None] * (4 - len(r))))[:4] + (len(r[1] or ""),) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return build
