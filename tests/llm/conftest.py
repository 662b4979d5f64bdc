from __future__ import annotations

import pytest

from fareloom.llm.common import ship_package

# Every column an operator might use for itself, besides those of documents.
CLASHING = "n_words long, size long, kept boolean, row string, node string, key string, rid long, body string, rank long"
DOCUMENTS = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def documents(spark):
    """Documents of (id, text) or (id, text, lang, source), with clashing columns."""

    def make(*rows):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, "en", "s")[:4] if len(row) == 2 else row
            n = None if text is None else len(text)
            full.append((doc_id, text, lang, source, n, 7, 7, True, "r", "n", "k", 7, "b", 7))
        return spark.createDataFrame(full, DOCUMENTS)

    return make
