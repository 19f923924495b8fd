import pytest

LONG = "lorem ipsum dolor sit amet " * 8000  # 40,000 words


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and columns with names the operators use."""
    rows = [
        (1, "alpha beta gamma\nshared line\nAlpha end", "en", 1.0, "x"),
        (1, "alpha beta gamma\nshared line\nAlpha end", "en", 1.0, "x"),  # the same row again
        (1, "another text under the same id", "en", 2.0, "x"),
        (2, None, "en", None, None),
        (3, "", None, 0.0, "y"),
        (4, "   \n\t \n", "en", 0.0, "y"),
        (None, "a text without an id", "en", 0.0, "y"),
        (None, None, None, None, None),
        (5, LONG, "en", 0.0, "z"),
        (6, "Ünïcode ßtraße 日本語 текст\nshared line", "de", 0.0, "z"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, id string").selectExpr(
        "*", "score as n_words", "id as fp", "id as row", "id as key", "id as made", "id as bucket", "score as fingerprint")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
