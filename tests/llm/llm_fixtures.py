import pytest

DOCS = "doc_id long, text string, lang string"


@pytest.fixture
def docs_of(spark):
    """A table of documents from (id, text) rows, over a few partitions."""

    def make(*rows):
        return spark.createDataFrame([(i, t, "en") for i, t in rows], DOCS).repartition(3)

    return make
