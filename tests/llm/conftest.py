import pytest


@pytest.fixture(scope="session")
def make(spark):
    """Rows to a DataFrame of (doc_id, text, lang, source, n_chars) with more columns on request."""

    def build(rows, schema="doc_id bigint, text string"):
        return spark.createDataFrame(rows, schema)

    return build
