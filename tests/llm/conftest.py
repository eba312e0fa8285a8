"""Small tables with the rows that go wrong first."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string, _id string"
PROSE = " ".join(f"word{i} and then some more" for i in range(60))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing column names."""
    rows = [
        (1, PROSE, "en", "a", 1, "x", "i"),
        (2, PROSE, "en", "b", 1, None, None),
        (2, PROSE, "en", "b", 1, None, None),
        (3, None, None, None, None, None, None),
        (4, "", "en", "a", 0, "x", "i"),
        (None, PROSE, "en", "a", 1, "x", "i"),
        (None, None, None, None, None, None, None),
        (5, " \t\n ", "en", "a", 4, "x", "i"),
        (6, "one", "en", "a", 3, "x", "i"),
        (7, "One", "en", "b", 3, "x", "i"),
        (8, ("long " * 60_000) + PROSE.upper(), "en", "c", 1, "x", "i"),
        (9, "x" * 50_000, "en", "c", 1, "x", "i"),
        (10, "ünïcödé 日本語 \U0001f600 <|endoftext|> <s>\x00 ▁▁a  b", "ja", "c", 1, "x", "i"),
        (11, PROSE + " changed", "en", "c", 1, "x", "i"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
