from __future__ import annotations

import pytest

from eventlake.llm.shared import prepare

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Build a documents table from (doc_id, text) pairs; further values fill the columns."""
    prepare(spark)

    def build(rows):
        filled = []
        for row in rows:
            doc_id, text, *rest = row
            lang, source = [*rest, "en", "src0"][:2] if len(rest) < 2 else rest[:2]
            filled.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(filled, DOC_SCHEMA)

    return build
