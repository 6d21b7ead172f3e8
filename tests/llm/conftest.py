import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents with every odd case: null id, text and source, empty and long texts, copies,
    repeated rows, and an extra column."""

    def make(rows):
        return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, Text2 string")

    return make
