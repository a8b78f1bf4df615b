from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Rows (doc_id, text) as documents; other columns have clashing names."""

    def make(rows, **extra):
        full = [
            (i, t, extra.get("lang", "en"), extra.get("source", "src"), 0, 1.5, "x", b"k") for i, t in rows
        ]
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long, score double, node string, key binary"
        )
        return spark.createDataFrame(full, schema)

    return make
