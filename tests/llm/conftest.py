import pytest
from corpus_cases import EDGES, docs_frame


@pytest.fixture(scope="session")
def edges(spark):
    return docs_frame(spark, EDGES)


@pytest.fixture(scope="session")
def nothing(spark):
    return docs_frame(spark, [])
