from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.llm import helpers


@pytest.fixture(scope="session")
def texts():
    return helpers.corpus()


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with sources and languages, and columns whose names operators use themselves."""
    rows = [
        (i, t, None if i % 11 == 0 else "en", None if i % 13 == 0 else f"s{i % 4}", "x", 1.5)
        for i, t in texts
    ]
    frame = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, size string, row double"
    )
    return frame.withColumns({"words": F.lit(1), "node": F.lit(2), "slab": F.lit(3)}).repartition(5)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
