from __future__ import annotations

import pytest

LONG = "lorem ipsum dolor " * 20_000


@pytest.fixture
def docs(spark):
    """Rows with clashing extra columns; ``rows`` are (doc_id, text) pairs."""

    def build(rows):
        return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, ids string, part int")

    return build


@pytest.fixture(autouse=True)
def _prepared(spark):
    from riskflow.llm.common import prepare

    prepare(spark)
