import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) rows, with columns whose names clash."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, "x", "en", 0, 1, 2) for i, t in rows],
            "doc_id long, text string, row string, lang string, at int, n int, component_id int")

    return make
