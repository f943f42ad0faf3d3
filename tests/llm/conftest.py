import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from texts; ids count from 0."""

    def make(texts, lang="en", partitions=3):
        rows = [(i, t, lang, "s", None if t is None else len(t)) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS).repartition(partitions)

    return make
