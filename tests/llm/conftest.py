from __future__ import annotations

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table from texts, or from (doc_id, text[, source[, lang]]) tuples, with a column more."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("n_chars", T.LongType()),
            # Names that operators use for columns of their own.
            T.StructField("score", T.StringType()),
            T.StructField("kept", T.StringType()),
        ]
    )

    def build(rows, partitions=3):
        full = []
        for i, row in enumerate(rows):
            doc_id, text, source, lang = (*row, None, None)[:4] if isinstance(row, tuple) else (i, row, None, None)
            full.append(Row(doc_id, text, lang, source, len(text or ""), "x", "y"))
        return spark.createDataFrame(full, schema).repartition(partitions) if full else spark.createDataFrame([], schema)

    return build
