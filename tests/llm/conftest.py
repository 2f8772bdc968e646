import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text, source)."""

    def make(*rows):
        return spark.createDataFrame(
            [(doc_id, text, None, source, None if text is None else len(text)) for doc_id, text, source in rows], DOCUMENTS
        )

    return make
