import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet").cache()


@pytest.fixture(scope="session")
def texts(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]


@pytest.fixture
def docs(spark):
    """A frame of documents from (doc_id, text) pairs, with columns whose names clash with internal ones."""

    def make(pairs):
        rows = [(i, t, "en", "s", len(t or ""), 1, "x", [1]) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS + ", hash int, key string, ranges array<int>")

    return make
