import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text[, lang, source]) rows."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

    def make(rows):
        full = [(tuple(r) + (None,) * 4)[:4] for r in rows]
        return spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in full], schema)

    return make
