import pytest
from pyspark.sql import types as T

from llm.cases import ODD

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture
def docs_of(spark):
    """A documents table from (doc_id, text[, lang, source]) with columns whose names clash with helpers' own."""

    def make(rows, extra=True):
        full = [(r[0], r[1], *(list(r[2:]) + ["en", "s"][len(r) - 2 :]), len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            for name in ("n", "rep", "doc", "pos", "start", "count", "host", "path", "key", "word", "hash"):
                df = df.selectExpr("*", f"'x' as {name}")
        return df

    return make


@pytest.fixture
def odd(docs_of):
    return docs_of(ODD)
