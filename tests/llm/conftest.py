from __future__ import annotations

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs_of(spark):
    """documents from texts (ids from 0) or (id, text) pairs, with extra columns of clashing names."""
    def make(texts, lang="en", **extra):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, lang, "src", None if t is None else len(t), *extra.values()) for i, t in rows]
        return spark.createDataFrame(rows, DOC_SCHEMA + "".join(f", {c} string" for c in extra))
    return make


@pytest.fixture(scope="session")
def sf001(spark):
    return "/root/testdata/sf0.001"
