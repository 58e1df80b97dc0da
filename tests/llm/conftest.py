from __future__ import annotations

import os
import random

import pytest

SF = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _row long, row_id string, digest string"


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF):
        pytest.skip("test tables are absent")
    return SF


@pytest.fixture()
def docs(spark):
    """documents with extra columns whose names the operators use inside."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", None, 7, "x", "y") for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and blank texts, repeats, white space of all kinds, very long texts."""
    r = random.Random(4)
    words = ["the", "of", "Über", "naïve", "日本", "é", "&&&", "don't", "x1", "<|endoftext|>", "\U0001f642", "A" * 40]
    long = " ".join(r.choices(words, k=30_000))
    return [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "a"), (5, "a"), (None, "a"), (None, None), (6, "A  b\tc"), (7, "a b\x0bc d"), (8, long), (9, long + " end"),
            (10, "z" * 50_000), (11, "one two three\x1cfour\x85five"), (12, "a\x00b \x00"), *((20 + i, " ".join(r.choices(words, k=i))) for i in range(12))]
