import sys

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    T.StructField("row_key", T.StringType()), T.StructField("node", T.IntegerType()),
    T.StructField("words", T.StringType()), T.StructField("size", T.LongType()),
])


def document_rows(texts, first=0, **fixed):
    """Rows for DOCUMENTS from texts; `fixed` gives other columns, per row if a list."""
    rows = []
    for i, text in enumerate(texts):
        def at(name, other):
            value = fixed.get(name, other)
            return value[i] if isinstance(value, list) else value
        rows.append((at("doc_id", first + i), text, at("lang", "en"), at("source", "s"),
                     None if text is None else len(text), "x", 1, "w", 5))
    return rows


@pytest.fixture
def documents(spark):
    return lambda texts, **fixed: spark.createDataFrame(document_rows(texts, **fixed), DOCUMENTS)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
