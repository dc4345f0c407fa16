from __future__ import annotations

import pytest

TEXTS = "doc_id long, text string"


@pytest.fixture
def texts(spark):
    """A table of documents with columns whose names operators use inside."""
    from pyspark.sql import functions as F

    def build(rows, schema=TEXTS):
        frame = spark.createDataFrame(rows, schema)
        extra = ("name", "block", "guest", "label", "base", "size", "chosen", "k1", "row", "shard")
        return frame.select("*", *[F.lit(7).alias(c) for c in extra if c not in frame.columns])

    return build
