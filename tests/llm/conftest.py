from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from conftest_llm import CLASHING, DOCUMENT  # noqa: E402


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text) rows, with columns whose names clash."""

    def make(rows, clash=True):
        df = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], DOCUMENT)
        if clash:
            from pyspark.sql import functions as F

            df = df.withColumns({c: F.lit("x") for c in CLASHING})
        return df

    return make
