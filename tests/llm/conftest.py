import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Build a small documents-like table, with columns whose names clash with those of the operators."""

    def build(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)

    return build
