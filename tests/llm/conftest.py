import pytest

LONG = "very long text " * 9000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, and columns that clash with results."""
    rows = [
        (1, None, None), (2, "", "en"), (3, "", None), (4, " \t\n", "en"), (5, "One two", "en"), (6, "one TWO", "en"), (6, "one TWO", "en"),
        (7, LONG, "en"), (8, LONG + "end", "en"), (None, "one two", "en"), (None, None, None), (9, "Ünï\u00a0cödé Σ", "el"), (10, "a" * 30_000, "en"),
    ]
    rows = [(i, t, lang, "src", len(t or ""), -1.0, "x", 5, None) for i, t, lang in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, n long, component_id long")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
