import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept int, size int"


@pytest.fixture(scope="session")
def odd(spark):
    """Null cells, empty and long texts, repeated rows, columns with clashing names."""
    body = " ".join(f"w{k % 97}x{k % 53}" for k in range(400))
    rows = [
        (1, body, "en", "a", 1, 1, 1),
        (1, body, "en", "a", 1, 1, 1),
        (2, body + " end", "en", None, None, 2, 2),
        (3, None, None, "b", None, None, None),
        (4, "", "en", "b", 0, 0, 0),
        (5, " \t\n ", "en", "b", 4, 0, 0),
        (None, "no id", "en", "a", 5, 0, 0),
        (6, "x" * 200_000, "en", "c", 200_000, 0, 0),
        (7, "ÄÖ 漢字\nline\nline\n", "de", "c", 1, 0, 0),
    ]
    return spark.createDataFrame(rows, DOCS)
