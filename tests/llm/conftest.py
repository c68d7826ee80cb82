import pytest
from pyspark.sql import types as T

from tests.conftest import SF001, SF01, spark  # noqa: F401

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make(spark):  # noqa: F811
    """A documents table from texts (ids 0, 1, ...) or (id, text) pairs."""
    def build(texts, lang="en"):
        rows = texts if texts and isinstance(texts[0], tuple) else list(enumerate(texts))
        return spark.createDataFrame([(r[0], r[1], lang, "s", len(r[1] or "")) for r in rows], DOC)
    return build


@pytest.fixture(scope="session")
def docs01(spark):  # noqa: F811
    return spark.read.parquet(f"{SF01}/documents.parquet")


@pytest.fixture(scope="session")
def texts01(docs01):
    return {r["doc_id"]: r["text"] for r in docs01.select("doc_id", "text").collect()}
