import pytest


def pytest_configure(config):
    config.addinivalue_line("markers", "llm: operators for training data")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns whose names the operators also use inside."""
    rows = [
        (1, "one two three four five six\nseven", "en", "a", "x", 1), (1, "one two three four five six\nseven", "en", "a", "x", 1),
        (2, None, None, None, None, None), (3, "", "fr", "b", "y", 2), (None, "text without id\n\n", "en", "b", "z", 3), (None, None, None, None, None, None),
        (4, "wort " * 30000, "de", "c", "w", 4), (5, "x" * 200000, "en", "c", "v", 5), (6, "1234 !!! ...", "en", "d", "u", 6), (2, "another row of id two", "en", "d", "t", 7),
        (7, "Ünïcödé ▁ ▁▁ \t tab\r\n 　 wide 😀 <s> <|endoftext|>", "es", "e", "s", 8),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, row string, _task int")


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
