from __future__ import annotations

import pytest

DATA = "/root/testdata/sf0.01"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """The given documents of the small data set."""
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture
def texts(spark):
    """A table of documents from (doc_id, text) rows."""

    def build(*rows):
        return spark.createDataFrame([(i, t, None, "s", 0) for i, t in rows], DOCUMENTS)

    return build
