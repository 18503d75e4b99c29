from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, and columns that operators use
    names of themselves."""
    long = " ".join(f"word{i}" for i in range(20_000))
    rows = [
        (1, "one two three four five six seven eight", "en", "s", 1, "x"),
        (1, "one two three four five six seven eight", "en", "s", 1, "x"),
        (2, "one two three four five six seven eight", None, None, None, None),
        (3, "", "en", "s", 0, "x"),
        (4, None, "en", "s", None, "x"),
        (None, "no id here at all for this text", "en", "s", 3, "x"),
        (None, None, None, None, None, None),
        (5, long, "en", "s", len(long), "x"),
        (6, long + " more", "en", "s", len(long), "x"),
        (7, "tiny", "en", "s", 4, "x"),
        (8, "é" * 40 + " \U0001f600 token = 'Zx9Kq81LmN02pQ7s' all rights reserved", "en", "s", 4, "x"),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, key string"
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")
