"""Fixtures of the operators' tests; modules import them by name."""

from __future__ import annotations

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Rows of ``documents`` from (doc_id, text) pairs."""

    def build(rows, lang="en"):
        return spark.createDataFrame(
            [(i, t, lang, "test", None if t is None else len(t)) for i, t in rows], DOC
        )

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Null ids and texts, empty and very long texts, ties and repeated rows."""
    long_text = " ".join(f"w{i % 997} and{i}" for i in range(30_000))
    return [
        (1, None),
        (2, ""),
        (3, " \n\t\n"),
        (4, "word"),
        (None, "Some text of a row without an id, long enough for shingles."),
        (5, long_text),
        (5, long_text),
        (6, "x" * 50_000),
        (7, "été <|endoftext|> 日本 \u0085 İ"),
    ]
