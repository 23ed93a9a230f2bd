from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of (doc_id, text) or (doc_id, text, source) as documents, with columns whose names operators use too."""

    def build(*rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", 7, "mine", True, 3) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS + ", size string, kept boolean, rule int")

    return build


ODD = [(None, None), (1, ""), (2, " \n\t"), (3, "one two"), (3, "one two"), (4, "word " * 30_000), (5, "Ünï \x1c códe x")]


@pytest.fixture(scope="session")
def odd(documents):
    """NULLs, empty and very long texts, repeated rows."""
    return documents(*ODD)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents((0, "")).limit(0)
