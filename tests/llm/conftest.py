from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def edge_documents(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, and an extra
    column whose name an operator might use."""
    long_text = "word number %d and more " * 4000 % tuple(range(4000))
    rows = [(1, "The same text is here twice, all of it.", "en", "a", 5, "x"),
            (1, "The same text is here twice, all of it.", "en", "a", 5, "x"),
            (2, "The same text is here twice, all of it.", "en", None, 5, None),
            (3, None, None, None, None, None), (4, "", "de", "a", 0, ""), (5, " \t\n ", "de", "b", 4, "y"),
            (6, long_text, "en", "b", len(long_text), "z"), (None, "Kein Schlüssel, aber Text ist da.", "de", "b", 3, "q"),
            (7, "a", "fr", "c", 1, "q"), (8, "é😀中 \u0000 123 !!", None, "c", 9, "q"), (9, "1234 5678 !!", "en", "c", 9, "q")]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, sig string")


@pytest.fixture(scope="session")
def no_documents(edge_documents):
    return edge_documents.limit(0)
