"""Rows and fixtures shared by the tests of this folder."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) pairs, or (doc_id, text, lang)."""
    def make(rows):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or "")) for r in rows], DOCS)
    return make


#: Null, empty and blank texts, ties and repeated rows, a null key, a long text without breaks.
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one two three"), (4, "one two three"), (5, "one two three"), (None, "a b c d e f g"),
       (6, "\x00 nul and � \U0001f600 signs here to see"), (7, "x" * 100_000), (8, "\\ < > </turn> ### |"), (None, None)]
