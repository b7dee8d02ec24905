"""Fixtures of the training-data tests."""

from __future__ import annotations

import pytest

ODD = "doc_id long, text string, lang string, source string, n_chars long, part int, node long, queue string"


@pytest.fixture
def frame(spark):
    """A documents table of (doc_id, text[, lang[, source]]) rows with extra columns that clash with inner names."""

    def make(rows):
        full = [(*row, *[None] * (4 - len(row)), len(row[1] or ""), 7, 8, "q") for row in rows]
        return spark.createDataFrame(full, ODD)

    return make


@pytest.fixture
def odd_rows():
    """Nulls in every column, empty and blank texts, ties, repeated rows, one long text."""
    long = " ".join(f"w{i % 5000}" for i in range(60_000))
    return [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \n\t ", None, "b"),
        (4, "the quick brown fox jumps over the lazy dog", "en", "b"),
        (4, "the quick brown fox jumps over the lazy dog", "en", "b"),
        (5, "the quick brown fox jumps over the lazy dog", "en", None),
        (6, "der schnelle braune Fuchs und der faule Hund", "de", "c"),
        (7, "12 + 30 = 42 !!", "de", "c"),
        (None, "der und die", None, None),
        (9, long, "en", "a"),
        (10, "x", None, "a"),
    ]


@pytest.fixture(scope="session")
def sample(spark):
    """The smallest documents table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def rows(df, *order):
    return sorted((tuple(r) for r in df.select(*order).collect()), key=str)
