"""Small frames with the awkward rows that every operator has to take."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SF_TEXT = "/root/testdata/sf0.01"

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"word{i}" for i in range(400)]


def sentence(first: int, n: int) -> str:
    return " ".join(WORDS[(first * 7 + i * (first + 3)) % len(WORDS)] for i in range(n))


ROWS = [
    (1, sentence(1, 120), "en", "a", 1), (2, sentence(1, 120), "en", "a", 1), (3, sentence(1, 119) + " changed", "en", "a", 1),
    (4, None, None, None, None), (5, "", "en", None, 0), (6, "   \n\t ", "de", "b", 6), (7, "short", "de", "b", 5),
    (8, "two words", "fr", "b", 9), (9, sentence(5, 300), "fr", "a", 1), (9, sentence(5, 300), "fr", "a", 1),
    (10, "x" * 30_000, "en", "a", 30_000), (11, " ".join(["again"] * 5000), "en", "a", 1),
    (12, "Ünïcode ﬁ \U0001f642 été \x00 nul\x85 \u2003 wide", "fr", "c", 1), (None, "no id at all here", "en", "c", 1),
    (13, sentence(5, 300).upper(), "en", "a", 1), (14, sentence(9, 200) + " " + sentence(1, 60), "en", "a", 1),
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    return spark.createDataFrame(ROWS, DOCUMENTS)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def clashing(odd_documents):
    """The same rows with extra columns named like results and internals."""
    names = ["n_words", "score", "spans", "replica", "block", "place", "row", "label", "part", "n_tokens", "fingerprint"]
    return odd_documents.select("*", *[F.lit("mine").alias(n) for n in names])


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_TEXT}/documents.parquet")
