import pytest


@pytest.fixture
def docs(spark):
    """documents-like table from (doc_id, text) pairs, in two partitions."""
    def make(rows, extra=""):
        kind = "doc_id long, text string" + extra
        return spark.createDataFrame(rows, kind).repartition(2)
    return make
