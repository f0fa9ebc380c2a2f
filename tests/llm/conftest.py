import pytest


@pytest.fixture(scope="session")
def docs(spark):
    from data import documents

    return documents(spark).cache()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
