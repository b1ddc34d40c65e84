from __future__ import annotations

import pytest
from pyspark.sql import types as T
from texts import awkward_texts

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def rows():
    return awkward_texts()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With an extra column whose name an operator might use itself."""
    data = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(data, DOCS).repartition(3)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same documents with columns named as operators name theirs."""
    from pyspark.sql import functions as F

    names = ["id", "key", "node", "words", "chunks", "tie", "row", "span", "start", "label", "gone"]
    return docs.select("*", *(F.lit("extra").alias(n) for n in names))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
