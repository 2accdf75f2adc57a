import sys
from pathlib import Path

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

sys.path[:0] = [str(p) for p in (Path(__file__).parent, *Path(__file__).parents[1:3])]
DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType()), StructField("n_chars", LongType())])


@pytest.fixture
def make(spark):
    """Documents from texts or (doc_id, text) pairs."""

    def go(rows, parts=2):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(d, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, (d, t) in enumerate(rows)]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return go
