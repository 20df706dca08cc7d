from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, a clashing column."""
    long_text = "word " * 30_000 + "end"
    rows = [
        (1, "the same text here for all of us", "en", "a", 1, 0.5),
        (1, "the same text here for all of us", "en", "a", 1, 0.5),
        (2, "the  same\ttext here for all of us", "en", "b", 1, 0.5),
        (3, None, None, None, None, None),
        (4, "", "en", "a", 0, 0.1),
        (None, "the same text here for all of us", "en", "a", 1, 0.5),
        (None, None, None, "b", None, None),
        (5, long_text, "en", "a", 1, 0.5),
        (5, "another text under a repeated id", "en", "a", 1, 0.5),
        (6, "x", "en", "c", 1, 0.5),
        (7, "  \n\t ", "en", "c", 1, 0.5),
        (8, "x" * 100_000, "en", "c", 1, 0.5),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
