"""Small tables for the operators: odd rows that every operator must take."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark):
    """Documents from (id, text) or (id, text, source) rows, spread over some partitions."""

    def build(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions, "doc_id")

    return build
