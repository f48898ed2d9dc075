import pytest


@pytest.fixture(scope="session")
def documents_of(spark):
    """Frame of (doc_id, text) rows, with columns whose names the operators use inside."""

    def make(rows):
        data = [(d, t, "en", "x", 1, b"y") for d, t in rows]
        return spark.createDataFrame(data, "doc_id long, text string, lang string, uid string, row int, digest binary")

    return make
