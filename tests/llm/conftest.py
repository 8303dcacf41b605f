"""Sessions and small frames for the operators' tests."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
#: The same with columns whose names the operators use for their own results.
CLASHING = T.StructType([*DOCS, *[T.StructField(c, T.StringType()) for c in ("score", "ids", "node", "n", "keep_id", "lang_pred", "removed", "words", "_x")]])


@pytest.fixture(scope="session")
def docs(spark):
    """docs(rows) -> DataFrame of (doc_id, text); docs(rows, True) with clashing extra columns."""

    def make(rows, clashing=False):
        if clashing:
            return spark.createDataFrame([(*r, *["x"] * (len(CLASHING) - 2)) for r in rows], CLASHING)
        return spark.createDataFrame(rows, DOCS)

    return make
