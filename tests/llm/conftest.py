from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs or from texts alone."""

    def make(rows, lang="en"):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(i, t, lang, "s", len(t or "")) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make
