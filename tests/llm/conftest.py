import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))  # shared brute-force forms

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows of documents from (doc_id, text) pairs; languages and sources are partly null."""

    def make(rows):
        return spark.createDataFrame([(i, t, None if k % 3 else "en", None, k) for k, (i, t) in enumerate(rows)], DOCS)

    return make
