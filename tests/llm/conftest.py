import pytest

DOC = "doc_id long, text string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A frame of documents with extra columns whose names clash with the operators' own."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", 1, "x") for i, t in rows], DOC + ", lang string, n_removed int, component string")

    return make
