"""Shared fixtures and constants; the session comes from the parent folder's conftest."""

import pytest

SF001 = "/root/testdata/sf0.001"
LOREM = "the quick brown fox jumps over the lazy dog while seven small birds sing in an old green tree near water"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty, blank, very long, tied and repeated rows, and columns named like ours."""
    long_text = " ".join(f"w{i % 997}x{i}" for i in range(60_000))
    rows = [(0, LOREM), (1, LOREM), (2, None), (3, ""), (4, " \n\t "), (5, "one two"), (6, "ONE two"),
            (7, long_text), (7, long_text), (8, LOREM + " and then some"), (None, LOREM), (9, "é ß x 😀\nThe end.")]
    data = [(i, t, None, "src", None, "x", 1, 2.0, True, "r") for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "node string, h int, score double, kept boolean, _id string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
