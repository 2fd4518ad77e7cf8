import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, range string, at string"


@pytest.fixture
def odd(spark):
    """Documents with nulls in every column, empty and long texts, ties and repeated rows, and clashing extra columns."""
    body = " ".join(f"word{i % 97} and{i % 13}" for i in range(400)) + "."
    near = body.replace("word96", "other")
    rows = [
        (1, body, "en", "a", 1, "r", "x"),
        (2, body, "en", "a", 1, "r", "x"),
        (2, body, "en", "a", 1, "r", "x"),
        (3, near, "en", None, None, None, None),
        (4, None, None, "b", None, None, None),
        (5, "", "de", "b", 0, "", ""),
        (6, " \t\n", "de", "b", 3, "", ""),
        (7, "one two", "de", "c", 7, "", ""),
        (8, "One TWO", None, "c", 7, "", ""),
        (None, "ein kurzer text ohne nummer", "de", "c", 7, "", ""),
        (None, body, None, None, None, None, None),
        (9, "löwe ünd straße " * 3000, "de", "b", 48000, "", ""),
        (10, "a " * 500, "en", "a", 1000, "", ""),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)
